"""Operator 12: how far the sources of a language diverge in their words.

Terms that enough documents of a language hold are sorted into a vocabulary: shards
of bounded size, each a minimal acyclic transducer from terms to lexicographic
ordinals. The texts are then streamed through it once more for the counts by source;
from there on a term is its ordinal, which also orders ties.

Nulls in lang, source or text are ''. Repeated rows are documents each. A text
without a term counts for nothing but makes its group occur; an empty table gives no
row. Other columns aren't read.
"""

from __future__ import annotations

import itertools
import uuid
from bisect import bisect_left, bisect_right
from collections import Counter, OrderedDict, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import filesystem, materialise, scratch, text_steps, write_file
from .transducer import Transducer
from .words import spread

#: Different terms that a task counts before it passes them on, and words.
HELD, HELD_WORDS = 200_000, 8_000_000
#: Terms, and bytes of terms, of a shard of the vocabulary.
SHARD_TERMS, SHARD_BYTES = 1 << 16, 4 << 20
#: Bytes of transducers that a worker keeps.
KEPT_BYTES = 96 << 20
#: Sources a side of a square of pairs, parts that its terms are dealt to, and
#: pairs of rows compared at once.
BLOCK, PARTS, PAIRS = 64, 256, 1 << 19

#: Terms are runs of letters a-z and of bytes from 128 on; A-Z are lowered.
_TERM = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_PART = 4 << 20


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in lists, a few for a very long text."""
    held = text.translate(_TERM)
    a = 0
    while len(held) - a > _PART and (cut := held.find(b" ", a + _PART)) >= 0:
        yield held[a:cut].split()
        a = cut
    yield held[a:].split()


def document_counts(docs: DataFrame) -> DataFrame:
    """(lang, term, n): in how many documents of a language each term is, in parts
    that are still to be summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, n in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], ["lang", "term", "n"])
            held.clear()

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for a, _, texts in text_steps(batch, "text"):
                for lang, text in zip(langs[a:], texts, strict=False):
                    held.setdefault(lang, Counter()).update(set().union(*terms(text)))
                if sum(map(len, held.values())) > HELD:
                    yield from flush()
        yield from flush()

    return docs.select("lang", "text").mapInArrow(count, "lang string, term binary, n long")


@dataclass(frozen=True)
class Shard:
    """One row of the vocabulary's index: its first term, terms before it in its
    language, and its file."""

    lang: str
    first: bytes
    base: int
    path: str


def vocabulary(kept: DataFrame, shard_terms: int = SHARD_TERMS) -> list[Shard]:
    """Writes the transducers of distinct (lang, term) rows; gives their index, one
    row for up to ``shard_terms`` terms. Tasks build the shards of ranges of terms."""
    spark = kept.sparkSession
    folder = scratch(spark, "vocabulary")
    parts = max(1, -(-kept.count() // shard_terms))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, held, size = None, [], 0

        def write() -> pa.RecordBatch:
            path = f"{folder}/{uuid.uuid4().hex}.npz"
            write_file(path, [Transducer.build(held).dump()])
            return pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([held[0]], pa.binary()), pa.array([len(held)], pa.int64()), pa.array([path])], ["lang", "first", "n", "path"])

        for batch in batches:
            for at, term in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist(), strict=True):
                if held and (at != lang or len(held) >= shard_terms or size >= SHARD_BYTES):
                    yield write()
                    held, size = [], 0
                lang = at
                held.append(term)
                size += len(term)
        if held:
            yield write()

    dealt = kept.select("lang", "term").repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")
    index = materialise(dealt.mapInArrow(build, "lang string, first binary, n long, path string"), "vocabulary-index")
    out, base, last = [], 0, None
    for r in index.orderBy("lang", "first").collect():
        base = base if r["lang"] == last else 0
        last = r["lang"]
        out.append(Shard(last, bytes(r["first"]), base, r["path"]))
        base += r["n"]
    return out


class Vocabulary:
    """The shards as a worker sees them: read when needed, least used ones let go."""

    def __init__(self, shards: list[Shard]):
        self.of: dict[str, list[Shard]] = {}
        for s in shards:
            self.of.setdefault(s.lang, []).append(s)
        self.first = {lang: [s.first for s in held] for lang, held in self.of.items()}
        self.kept: OrderedDict[str, Transducer] = OrderedDict()

    def _shard(self, path: str) -> Transducer:
        if path not in self.kept:
            fs, at = filesystem(path)
            with fs.open_input_stream(at) as f:
                self.kept[path] = Transducer.load(f.read())
            while len(self.kept) > 1 and sum(t.n_bytes for t in self.kept.values()) > KEPT_BYTES:
                self.kept.popitem(last=False)
        self.kept.move_to_end(path)
        return self.kept[path]

    def ordinals(self, lang: str, found: list[bytes]) -> np.ndarray:
        """Ordinals, or -1, of sorted terms: each shard is gone to once."""
        out = np.full(len(found), -1, np.int64)
        first = self.first.get(lang, [])
        for k, shard in enumerate(self.of.get(lang, [])):
            a = bisect_left(found, shard.first)
            b = bisect_left(found, first[k + 1]) if k + 1 < len(first) else len(found)
            if a < b:
                at = self._shard(shard.path).ordinals(found[a:b])
                out[a:b] = np.where(at >= 0, at + shard.base, -1)
        return out

    def term(self, lang: str, ordinal: int) -> bytes:
        held = self.of[lang]
        shard = held[bisect_right([s.base for s in held], ordinal) - 1]
        return self._shard(shard.path).term(ordinal - shard.base)


def recount(docs: DataFrame, shards: list[Shard]) -> DataFrame:
    """(lang, source, ord, n): occurrences of the vocabulary's terms, in parts that
    are still to be summed. Words go through the transducers where they are read;
    only ordinals are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(shards)
        # a number for each term of a language, and the numbers of each source's words
        number: dict[str, defaultdict[bytes, int]] = {}
        held: dict[tuple[str, str], list[np.ndarray]] = {}
        n_words = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, known in number.items():
                found = sorted(known)
                ordinal = np.empty(len(found), np.int64)
                ordinal[np.fromiter(map(known.__getitem__, found), np.int64, len(found))] = words.ordinals(lang, found)
                for source in [k[1] for k in held if k[0] == lang]:
                    times = np.bincount(np.concatenate(held[lang, source]), minlength=len(found))
                    there = np.flatnonzero((times > 0) & (ordinal >= 0))
                    same = lambda name, n=len(there): pa.array([name], pa.string()).take(pa.array(np.zeros(n, np.int32)))
                    yield pa.RecordBatch.from_arrays([same(lang), same(source), pa.array(ordinal[there]), pa.array(times[there])], ["lang", "source", "ord", "n"])
            number.clear()
            held.clear()

        for batch in batches:
            keys = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True))
            for a, _, texts in text_steps(batch, "text"):
                for key, text in zip(keys[a:], texts, strict=False):
                    known = number.get(key[0])
                    if known is None:
                        known = number[key[0]] = defaultdict(itertools.count().__next__)
                    mine = held.setdefault(key, [])
                    for found in terms(text):
                        mine.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
                        n_words += len(found)
                if n_words > HELD_WORDS or sum(map(len, number.values())) > HELD:
                    yield from flush()
                    n_words = 0
        yield from flush()

    return docs.select("lang", "source", "text").mapInArrow(count, "lang string, source string, ord long, n long")


def _share(n: str, total: str) -> F.Column:
    """1 + floor(1e9 * (n + 1) / total), exactly."""
    return F.expr(f"1 + (CAST(1000000000 AS DECIMAL(10,0)) * (CAST({n} AS DECIMAL(20,0)) + 1)) DIV CAST({total} AS DECIMAL(20,0))")


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q) ** 2 / q); both are at most 1e9 + 1, so it fits a long."""
    return (p - q) * (p - q) // q


class _Square:
    """Sums of the divergence over all terms for the pairs of two blocks of sources.

    With p0 the share of a term that a source doesn't have, the sum over all V terms is
    V f(p0g, p0h), plus what each source's own terms change against the other's p0,
    plus what the terms of both change against that. So only terms that occur are
    looked at, and the few different counts of a source are looked at once.
    """

    def __init__(self, cell: tuple):
        self.cell = cell
        self.side = 2 * BLOCK
        self.zero = np.zeros(self.side, np.int64)  # p0; 0: no such source
        self.v = 0  # terms of the language, in one of the square's parts
        self.sums = np.zeros((self.side, self.side), np.int64)

    def source(self, at: np.ndarray, zero: np.ndarray) -> None:
        self.zero[at] = zero

    def add(self, term: np.ndarray, at: np.ndarray, p: np.ndarray) -> None:
        """Rows of whole terms, in order of the terms."""
        if not len(term):
            return
        known = np.flatnonzero(self.zero)
        z = self.zero[known]
        (g, share), times = np.unique(np.stack((at, p)), axis=1, return_counts=True)
        share, times, mine = share[:, None], times[:, None], self.zero[g][:, None]
        there, back = np.zeros((2, self.side, len(known)), np.int64)
        np.add.at(there, g, times * (divergence(share, z) - divergence(mine, z)))
        np.add.at(back, g, times * (divergence(z, share) - divergence(z, mine)))
        self.sums[:, known] += there
        self.sums[known, :] += back.T
        edge = np.flatnonzero(np.diff(term, prepend=term[0] - 1))
        size = np.diff(np.append(edge, len(term)))
        begin, rows = np.repeat(edge, size), np.repeat(size, size)
        step = max(1, PAIRS // self.side)
        for x in range(0, len(term), step):
            mine = slice(x, min(x + step, len(term)))
            i = np.repeat(np.arange(mine.start, mine.stop), rows[mine])
            j = spread(begin[mine], rows[mine])
            i, j = i[i != j], j[i != j]
            g, h = at[i], at[j]
            change = divergence(p[i], p[j]) - divergence(p[i], self.zero[h]) - divergence(self.zero[g], p[j]) + divergence(self.zero[g], self.zero[h])
            np.add.at(self.sums, (g, h), change)

    def rows(self) -> pa.RecordBatch:
        lang, lo, hi = self.cell
        known = np.flatnonzero(self.zero)
        z = self.zero[known]
        self.sums[np.ix_(known, known)] += self.v * divergence(z[:, None], z[None, :])
        g, h = (x.ravel() for x in np.meshgrid(known, known, indexing="ij"))
        # a pair belongs to the square of its two blocks
        go = (g != h) & ((lo == hi) | ((g < BLOCK) != (h < BLOCK)))
        g, h = g[go], h[go]
        name = lambda x: np.where(x < BLOCK, lo * BLOCK + x, hi * BLOCK + x - BLOCK)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(name(g)), pa.array(name(h)), pa.array(self.sums[g, h])], ["lang", "g", "h", "value"])


def _sum_squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (lang, lo, hi, ord): first sources (ord -1), then terms."""
    square: _Square | None = None
    rest: list[np.ndarray] = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        if not batch.num_rows:
            continue
        langs = batch.column("lang").to_pylist()
        lo, hi, term, at, p, v = (batch.column(c).to_numpy() for c in ("lo", "hi", "ord", "at", "p", "v"))
        new = np.array([True] + [a != b for a, b in zip(langs, langs[1:], strict=False)]) | (np.diff(lo, prepend=-1) != 0) | (np.diff(hi, prepend=-1) != 0)
        cuts = np.append(np.flatnonzero(new), len(langs)).tolist()
        for a, b in zip(cuts, cuts[1:], strict=False):
            cell = (langs[a], int(lo[a]), int(hi[a]))
            if square is None or square.cell != cell:
                if square is not None:
                    square.add(*rest)
                    yield square.rows()
                square, rest = _Square(cell), [np.zeros(0, np.int64)] * 3
            first = int(np.searchsorted(term[a:b], 0)) + a
            square.source(at[a:first], p[a:first])
            square.v = max(square.v, int(v[a:first].max(initial=0)))
            held = [np.concatenate((x, y[first:b])) for x, y in zip(rest, (term, at, p), strict=True)]
            # the last term may go on in the next batch
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            square.add(*(x[:cut] for x in held))
            rest = [x[cut:] for x in held]
    if square is not None:
        square.add(*rest)
        yield square.rows()


def _pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, g, h, value) of all ordered pairs of sources of a language.

    Sources are dealt to blocks, the terms of each square of two blocks to ``PARTS``
    parts. A task holds the sums of one square.
    """
    blocks = f"CAST((n_sources - 1) DIV {BLOCK} AS INT)"
    cell = lambda df: df.withColumn("_other", F.explode(F.expr(f"sequence(0, {blocks})"))).selectExpr(
        "*", f"idx DIV {BLOCK} AS _own"
    ).selectExpr("*", "least(_own, _other) AS lo", "greatest(_own, _other) AS hi", f"idx % {BLOCK} + IF(_own <= _other, 0, {BLOCK}) AS at")
    salted = groups.withColumn("salt", F.explode(F.expr(f"sequence(0, {PARTS - 1})")))
    sources = cell(salted).selectExpr("lang", "lo", "hi", "CAST(salt AS BIGINT) AS salt", "CAST(-1 AS BIGINT) AS ord", "at", "p0 AS p", "IF(salt = 0, v, 0) AS v")
    own = counts.select("lang", "source", "ord", "p").join(groups.select("lang", "source", "idx", "n_sources"), ["lang", "source"])
    rows = cell(own).selectExpr("lang", "lo", "hi", f"pmod(ord, {PARTS}) AS salt", "ord", "at", "p", "CAST(0 AS BIGINT) AS v")
    dealt = sources.unionByName(rows).repartition("lang", "lo", "hi", "salt").sortWithinPartitions("lang", "lo", "hi", "ord")
    parts = dealt.mapInArrow(_sum_squares, "lang string, g long, h long, value long")
    return parts.groupBy("lang", "g", "h").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group (lang, source).

    With c occurrences of a term in a group and N of all V kept terms, its share is
    1 + floor(1e9 (c + 1) / (N + V)), and a divergence floor((p - q)**2 / q). Part
    ``pair``: each other source of the language, its divergence summed over all kept
    terms. Part ``term``: the ``top`` terms that the group has more of than its language.
    Ranks are by value, then by the item's bytes.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = materialise(document_counts(docs).groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term"), "kept-terms")
    shards = vocabulary(kept, shard_terms)

    parts = recount(docs, shards).repartition("lang", "ord").groupBy("lang", "source", "ord").agg(F.sum("n").alias("n"))
    counts = materialise(parts.withColumn("n_lang", F.sum("n").over(Window.partitionBy("lang", "ord"))), "term-counts")

    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    total = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = Window.partitionBy("lang")
    groups = (
        docs.select("lang", "source").distinct()
        .join(total, ["lang", "source"], "left").join(sizes, "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"))
        .withColumns({"total_lang": F.sum("total").over(by_lang), "n_sources": F.count(F.lit(1)).over(by_lang), "idx": (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long")})
        # without a kept term nothing is summed; any share will do
        .withColumn("p0", F.when(F.col("v") > 0, _share("0", "greatest(total + v, 1)")).otherwise(F.lit(1)).cast("long"))
    )
    groups = materialise(groups, "term-groups")

    shares = counts.join(groups.select("lang", "source", "total", "total_lang", "v"), ["lang", "source"])
    shares = shares.select("lang", "source", "ord", _share("n", "(total + v)").cast("long").alias("p"), _share("n_lang", "(total_lang + v)").cast("long").alias("q"))

    ranked = Window.partitionBy("lang", "source")
    term = shares.where("p > q").withColumn("value", F.expr("((p - q) * (p - q)) DIV q"))
    term = term.withColumn("rank", F.row_number().over(ranked.orderBy(F.desc("value"), "ord"))).where(F.col("rank") <= top)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(shards)
        for batch in batches:
            # in order, so that each shard is gone to once
            keys = list(zip(batch.column("lang").to_pylist(), batch.column("ord").to_pylist(), strict=True))
            found = {k: words.term(*k).decode() for k in sorted(set(keys))}
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("lang", "source")), pa.array([found[k] for k in keys], pa.string()), *(batch.column(c) for c in ("value", "rank"))], ["lang", "source", "item", "value", "rank"])

    term = term.select("lang", "source", "ord", "value", "rank").mapInArrow(name, "lang string, source string, item string, value long, rank int")

    names = groups.select("lang", "source", "idx")
    pair = _pairs(shares, groups)
    pair = pair.join(names.withColumnRenamed("idx", "g"), ["lang", "g"]).join(names.select("lang", F.col("source").alias("item"), F.col("idx").alias("h")), ["lang", "h"])
    pair = pair.withColumn("rank", F.row_number().over(ranked.orderBy(F.desc("value"), "item")))

    cols = ["lang", "source", "part", "item", "value", "rank"]
    return pair.withColumn("part", F.lit("pair")).select(cols).unionByName(term.withColumn("part", F.lit("term")).select(cols))
