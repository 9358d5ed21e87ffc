"""Operator 8: near duplicates by MinHash bands, odd sketches and exact sets.

One pass over the texts gives each document its shingle set's digest, the keys
of its MinHash bands and an odd sketch: a bitmap of the parities of where its
MinHash samples (the least hashes of the set) fall. The XOR of two sketches has a
bit for (nearly) each sample in which the sets differ, so its population count
estimates high similarities closely; of sets no larger than the sample it gives
the difference itself. Equal sets are one class.

Links are found in rounds. In a round every class meets one centre of each of its
buckets, another one each round, unless both are in one component already; the
sketch says which centre is nearest, and an exact comparison of the full sets,
which alone makes a link, joins the two components. So a round costs a row for
each place in a bucket, however many classes that bucket holds and however many
of its pairs are links. Rounds end when their yield says that few links between
different components can be left; then all pairs of a bucket that are still in
different components are looked at once. Components come from alternating large
and small stars.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, text_steps
from .shingles import shingle_sets
from .words import mix, spread

#: Sets whose samples are held at once, however short their texts are.
SETS = 512
#: Classes a side of the squares in which a bucket's pairs are looked at.
BLOCK = 1500


@dataclass(frozen=True)
class Settings:
    """Links are pairs with ``percent`` * union <= 100 * intersection."""

    words: int = 5
    percent: int = 80
    #: MinHash samples, and bits of the odd sketch they are folded into.
    samples: int = 2048
    bits: int = 4096
    #: Rows of a band, and the chance that a pair at the threshold shares no band.
    rows: int = 5
    miss: float = 1e-6
    #: Deviations of the estimate beyond which a pair isn't compared.
    deviations: float = 5.0

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** self.rows))


def most_odd(a: np.ndarray, b: np.ndarray, s: Settings) -> np.ndarray:
    """Most odd bits of two sketches of sets of these sizes that may be a link.

    Two sets at the threshold have c = percent * (a + b) / (100 + percent) hashes
    in common; of those a sample of the larger set holds a hypergeometric number.
    Folding never makes more bits odd than samples differ. Sizes too far apart for
    a link give less than no bit.
    """
    low, most = np.minimum(a, b), np.maximum(a, b).astype(float)
    part = np.minimum(np.ceil(s.percent * (a + b) / (100 + s.percent)) / most, 1.0)
    held = np.minimum(most, s.samples)
    spread = np.sqrt(np.maximum(2 * held * part * (1 - part) * (1 - held / most), 0.0))
    odd = np.minimum(low, s.samples) + held - 2 * (held * part - s.deviations * spread)
    return np.where(100 * low >= s.percent * most, odd, -1.0)


def signatures(values: np.ndarray, of: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (int64, sets x bands) and odd sketches (int64, sets x bits/64)
    of non-empty sorted sets of 64-bit hashes."""
    turn = np.random.Generator(np.random.PCG64(17)).integers(1, 1 << 63, s.bands * s.rows, dtype=np.uint64) | np.uint64(1)
    n = len(of) - 1
    keys = np.empty((n, s.bands), np.uint64)
    for b in range(s.bands):
        h = np.full(n, b + 1, np.uint64)
        for j in range(b * s.rows, (b + 1) * s.rows):
            h = mix(h * np.uint64(31) + np.minimum.reduceat(values * turn[j], of[:-1]))
        keys[:, b] = h
    size = np.minimum(np.diff(of), s.samples)
    spot = (mix(values[spread(of[:-1], size)]) % np.uint64(s.bits)).astype(np.int64)
    odd = np.bincount(spot + np.repeat(np.arange(n) * s.bits, size), minlength=n * s.bits) & 1
    sketch = np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").reshape(n, -1)
    return keys.view(np.int64), sketch


def sign(docs: DataFrame, s: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, n_shingles, set, bands, sketch) of every document, from its
    whole text; ``row`` tells rows of one id apart, ``set`` is the digest of the
    shingle set. No words: no bands."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_steps(batch, "t"):
                values, of = shingle_sets(texts, s.words)
                n = np.diff(of)
                full = np.flatnonzero(n)
                bands: list = [[]] * len(texts)
                sketch: list = [[]] * len(texts)
                # the empty ones between have no values, so these lie side by side
                begin = np.append(of[full], of[-1])
                for x in range(0, len(full), SETS):
                    part = full[x : x + SETS]
                    inside = begin[x : x + len(part) + 1]
                    keys, odd = signatures(values[inside[0] : inside[-1]], inside - inside[0], s)
                    for i, k, o in zip(part.tolist(), keys, odd, strict=True):
                        bands[i], sketch[i] = k, o
                digest = [hashlib.md5(values[x:y].tobytes(), usedforsecurity=False).digest() for x, y in zip(of[:-1].tolist(), of[1:].tolist(), strict=True)]
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, longs), pa.array(sketch, longs)], ["doc_id", "row", "n_shingles", "set", "bands", "sketch"])

    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t"))
    return rows.mapInArrow(make, "doc_id long, row long, n_shingles long, set binary, bands array<long>, sketch array<long>")


def _rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    held = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return held.flatten().to_numpy(zero_copy_only=False).reshape(len(held), -1)


def odd_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which sketches differ, by row. The words are signed as Arrow has
    them; ``bitwise_count`` takes the absolute value of such, so they are viewed
    as unsigned."""
    return np.bitwise_count((a ^ b).view(np.uint64)).sum(-1, dtype=np.int64)


def nearest(stars: DataFrame, s: Settings) -> DataFrame:
    """Of rows with two classes (a_..., b_...), those whose sketches may be a link,
    with ``far``, the odd bits of their XOR."""
    names = ["a", "a_in", "a_doc", "a_row", "b", "b_in", "b_doc", "b_row", "m"]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = odd_bits(_rows(batch["a_sketch"]), _rows(batch["b_sketch"])) if batch.num_rows else np.zeros(0, np.int64)
            go = pa.array(far <= most_odd(batch["a_n"].to_numpy(), batch["b_n"].to_numpy(), s))
            yield pa.RecordBatch.from_arrays([*(batch[c].filter(go) for c in names), pa.array(far).filter(go)], [*names, "far"])

    return stars.mapInArrow(near, "a binary, a_in binary, a_doc long, a_row long, b binary, b_in binary, b_doc long, b_row long, m long, far long")


def squares(left: pa.Table, right: pa.Table, s: Settings) -> pa.Table:
    """Pairs of classes of some squares (key, x, y) that are in different components
    and whose sketches may be a link, each in the first bucket that it shares only."""
    place = [np.stack([t[c].to_numpy() for c in ("key", "x", "y")], 1) for t in (left, right)]
    _, of = np.unique(np.concatenate(place), axis=0, return_inverse=True)
    mine, other = (np.argsort(x, kind="stable") for x in (of[: len(place[0])], of[len(place[0]) :]))
    squares_of = of[: len(place[0])][mine], of[len(place[0]) :][other]
    a_sketch, b_sketch, a_bands, b_bands = (_rows(t[c]) for c in ("sketch", "bands") for t in (left, right))
    a_n, b_n, band = left["n"].to_numpy(), right["n"].to_numpy(), left["band"].to_numpy()
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for q in np.unique(squares_of[0]).tolist():
        i, j = (o[slice(*np.searchsorted(sq, [q, q + 1]))] for o, sq in zip((mine, other), squares_of, strict=True))
        theirs = b_sketch[j]
        for x in i.tolist():
            far = odd_bits(a_sketch[x], theirs)
            y = j[far <= most_odd(a_n[x], b_n[j], s)]
            y = y[~(a_bands[x, : band[x]] == b_bands[y, : band[x]]).any(1)]
            found.append((np.full(len(y), x), y))
    x, y = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
    out = [left[c].take(pa.array(x)).combine_chunks() for c in ("set", "component", "doc_id", "row")] + [right[c].take(pa.array(y)).combine_chunks() for c in ("set", "component", "doc_id", "row", "main")]
    pairs = pa.Table.from_arrays(out, ["a", "a_in", "a_doc", "a_row", "b", "b_in", "b_doc", "b_row", "main"])
    apart = [p != q and (q == main or a < b) for a, p, b, q, main in zip(*(pairs[c].to_pylist() for c in ("a", "a_in", "b", "b_in", "main")), strict=True)]
    return pairs.filter(pa.array(apart, pa.bool_())).select(["a_in", "a_doc", "a_row", "b_in", "b_doc", "b_row"])


def verify(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Of the pairs (a_doc, a_row, b_doc, b_row: the rows that stand for two
    classes; a_in, b_in: their components; m), (a_in, b_in, m) of those whose full
    sets are similar enough. ``texts``: doc_id, row, text."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for a, b, left in text_steps(batch, "ta"):
                right = batch.column("tb").slice(a, b - a).cast(pa.large_binary()).to_pylist()
                va, oa = shingle_sets(left, s.words)
                vb, ob = shingle_sets([t or b"" for t in right], s.words)
                for i in range(b - a):
                    x, y = va[oa[i] : oa[i + 1]], vb[ob[i] : ob[i + 1]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[a + i] = 100 * both >= s.percent * (len(x) + len(y) - both)
            yield batch.select(["a_in", "b_in", "m"]).filter(pa.array(keep))

    pairs = materialise(pairs, "pairs")
    need = pairs.select(F.explode(F.array(F.struct(F.col("a_doc").alias("d"), F.col("a_row").alias("r")), F.struct(F.col("b_doc").alias("d"), F.col("b_row").alias("r")))).alias("x")).select("x.*").distinct()
    held = texts.join(need, texts["doc_id"].eqNullSafe(need["d"]) & (texts["row"] == need["r"])).select("d", "r", "text")
    # rows that repeat an id and a text are one
    held = materialise(held.groupBy("d", "r").agg(F.first("text").alias("text")), "pair-texts")
    both = pairs
    for k in "ab":
        t = held.select(F.col("d").alias(f"{k}_d"), F.col("r").alias(f"{k}_r"), F.col("text").alias(f"t{k}"))
        both = both.join(t, both[f"{k}_doc"].eqNullSafe(t[f"{k}_d"]) & (both[f"{k}_row"] == t[f"{k}_r"])).drop(f"{k}_d", f"{k}_r")
    return materialise(both.select("a_in", "b_in", "m", "ta", "tb").mapInArrow(compare, "a_in binary, b_in binary, m long"), "links")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes in edges (a, b); a component is named by its
    least node. Alternates large and small stars until nothing changes."""
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: greater neighbours point to the least of the neighbourhood
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        # small star: lesser neighbours, and the node, point to the least of them
        small = large.join(down, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = materialise(small.where("a <> b").distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _mixed(members: DataFrame, *more: Column) -> DataFrame:
    """Buckets that hold several components, with further aggregates."""
    ends = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), *more)
    return ends.where("low <> high").drop("low", "high")


def _relabel(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members with the components that the links found make."""
    named = components(found.select(F.col("a_in").alias("a"), F.col("b_in").alias("b")))
    joined = members.join(named, members["component"] == named["node"], "left")
    return materialise(joined.select("key", "band", "set", F.coalesce(named["component"], members["component"]).alias("component")), "members")


def grouped(classes: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """(set, component) of the classes (set, doc_id, row, n_shingles, bands,
    sketch) that share a bucket with another one."""
    keyed = materialise(classes.select("set", F.posexplode("bands").alias("band", "key")), "bands")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = materialise(keyed.join(shared, "key").select("key", "band", "set", F.col("set").alias("component")), "members")
    about = classes.select("set", "doc_id", "row", F.col("n_shingles").alias("n"), "sketch", "bands")
    a, b = (about.select(F.col("set").alias(k), *(F.col(c).alias(f"{k}_{n}") for c, n in (("doc_id", "doc"), ("row", "row"), ("n", "n"), ("sketch", "sketch")))) for k in "ab")
    enough, turn = classes.count(), 0
    while True:
        pick = F.min(F.struct(F.xxhash64("set", F.lit(turn)).alias("h"), "set", "component")).alias("c")
        centres = _mixed(members, pick, F.count("*").alias("m")).select("key", F.col("c.set").alias("b"), F.col("c.component").alias("b_in"), "m")
        stars = members.join(centres, "key").where("component <> b_in").groupBy(F.col("set").alias("a"), F.col("component").alias("a_in"), "b", "b_in").agg(F.max("m").alias("m"))
        best = nearest(stars.join(a, "a").join(b, "b"), s).groupBy("a", "a_in", "a_doc", "a_row").agg(F.min(F.struct("far", "b", "b_in", "b_doc", "b_row", "m")).alias("to"))
        found = verify(best.select("a_in", "a_doc", "a_row", "to.b_in", "to.b_doc", "to.b_row", "to.m"), texts, s)
        # A centre is any of m classes: a link found stands for about m / 2 links that
        # were there, so this bounds what the last step would find at once.
        left = (found.agg(F.sum("m")).first()[0] or 0) / 2
        members, turn = _relabel(members, found), turn + 1
        if left <= enough:
            break
    # Last, the pairs of a bucket that are still apart, but not those inside its largest
    # component. A bucket is cut into squares of BLOCK x BLOCK, so that no task has a hot one.
    sizes = members.groupBy("key", "component").count()
    mains = sizes.groupBy("key").agg(F.max(F.struct("count", "component")).alias("x"), F.sum("count").alias("m"))
    mains = mains.where("m > x.count").select("key", F.col("x.component").alias("main"), F.ceil((F.col("m") - F.col("x.count")) / BLOCK).alias("down"), F.ceil(F.col("m") / BLOCK).alias("across"), "m", "x")
    mixed = materialise(members.join(mains.drop("m", "x"), "key"), "mixed")
    block = lambda n: F.pmod(F.xxhash64("set"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left_side = mixed.where("component <> main").select("key", "band", block("down").alias("y"), every("across").alias("x"), "set", "component").join(about, "set")
    right_side = mixed.select("key", every("down").alias("y"), block("across").alias("x"), "set", "component", "main").join(about, "set")
    n = mains.select(F.sum(F.col("down") * F.col("m") + F.col("across") * (F.col("m") - F.col("x.count")))).first()[0] or 0
    # many small squares a group, or one of full size
    dealt = F.pmod(F.xxhash64("key", "x", "y"), F.lit(int(n) // (4 * BLOCK) + 1))
    sides = (t.withColumn("dealt", dealt) for t in (left_side, right_side))
    sides = (t.toDF(*t.columns).groupBy("dealt") for t in sides)  # columns of their own
    rest = next(sides).cogroup(next(sides)).applyInArrow(lambda p, q: squares(p, q, s), "a_in binary, a_doc long, a_row long, b_in binary, b_doc long, b_row long")
    rest = rest.distinct().withColumn("m", F.lit(0).cast("long"))
    return _relabel(members, verify(rest, texts, s)).select("set", "component").distinct()


def near_duplicates(docs: DataFrame, settings: Settings | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, n_shingles, component_id, kept, first) per row of ``docs``.

    component_id is the smallest doc_id that links reach. Null or wordless texts
    link with nothing: their component is their own doc_id. ``first`` marks the
    rows that stand for their component: of the smallest doc_id and, among those,
    the least ``row`` (a hash of the text). A null doc_id is in a component but
    names one only where no other id is; ``kept`` is doc_id = component_id, and
    ``first`` in components of null ids only. Rows that repeat an id and a text are
    marked alike. An empty table gives no rows.
    """
    s = settings or Settings()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    signed = materialise(sign(docs, s, id_col, text_col), "signed")
    narrow = signed.select("doc_id", "row", "n_shingles", "set")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("r")
    classes = signed.where("n_shingles > 0").groupBy("set").agg(first, F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = materialise(classes.select("set", "r.doc_id", "r.row", "n_shingles", "bands", "sketch"), "classes")
    named = grouped(classes, texts, s)
    owned = classes.select("set", "doc_id", "row").join(named, "set", "left").select("set", F.coalesce("component", "set").alias("component"), "doc_id", "row")
    least = owned.groupBy("component").agg(first).select("component", F.col("r.doc_id").alias("component_id"), F.col("r.row").alias("_row"))
    where = owned.join(least, "component").select("set", "component_id", "_row")
    out = narrow.where("n_shingles > 0").join(where, "set")
    named_by = F.col("doc_id").eqNullSafe(F.col("component_id"))
    out = out.withColumn("first", named_by & (F.col("row") == F.col("_row")))
    out = out.select("doc_id", "row", "n_shingles", "component_id", F.when(F.col("component_id").isNull(), F.col("first")).otherwise(named_by).alias("kept"), "first")
    alone = narrow.where("n_shingles = 0").select("doc_id", "row", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), F.lit(True).alias("first"))
    return out.union(alone)


def drop_near_duplicates(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, all its columns.

    The row is the one that ``first`` of ``near_duplicates`` marks; of several that
    repeat its id and text, the one whose columns hash least. Rows without words
    stay, once for each id and text.
    """
    found = near_duplicates(docs, settings).where("first").select(F.col("doc_id").alias("_i"), F.col("row").alias("_h"))
    keep = materialise(found.groupBy("_i", "_h").count(), "kept")

    def rows(of: DataFrame) -> DataFrame:
        return docs.join(of, docs["doc_id"].cast("long").eqNullSafe(of["_i"]) & F.xxhash64(docs["text"]).eqNullSafe(of["_h"]), "left_semi")

    several = keep.where("count > 1")
    once = rows(keep.where("count = 1"))
    if several.isEmpty():
        return once
    again = rows(several)
    by_hash = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)))
    again = again.withColumn("_place", F.row_number().over(by_hash)).where("_place = 1")
    return once.union(again.select(*(F.col(f"`{c}`") for c in docs.columns)))
