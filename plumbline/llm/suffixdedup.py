"""Operator 11: removes what is covered by strings that also start earlier.

Every string of ``least`` bytes has an anchor, the part of ``ANCHOR`` bytes whose hash
is least in it, and equal strings have equal anchors at the same place. So the texts
are dealt by anchors: a run of neighbouring strings with one anchor is one row. Of
rows with the same bytes only the first stays. Where an anchor is left with several
contexts, these are fetched and the strings in them compared in tasks of bounded size
by a Burrows-Wheeler transform whose intervals are expanded up to ``least`` bytes.
An anchor with more than ``contexts`` contexts (the end of a passage that very many
documents share) is dealt once more, by longer anchors: neighbouring strings go as one
run where another text has the run, and few anchors have many contexts again. Only the
strings of those are dealt singly, by their hashes.

Only hashes of all texts are shuffled, and the texts twice: to fetch contexts, and to
cut them. Hashes are of 128 bits (an anchor's and its context's).

A null text is empty. A null id is the least. Of rows that repeat an id, one whose text
hashes less comes first; of rows that repeat id and text, the second and later are
copies of the first. Other columns aren't read; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bwt import classes
from .common import STEP_BYTES, materialise, text_steps
from .words import mix, segments, spread

#: Bytes of an anchor.
ANCHOR = 32
#: Contexts of one anchor that a task takes together, and bytes of contexts of
#: several anchors that it transforms at once.
CONTEXTS, BATCH_BYTES = 256, 1 << 20

_RANDOM = np.random.Generator(np.random.PCG64(11))
#: A random number for each byte, and the two bases of the rolling hashes.
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = [int(b) | 1 for b in _RANDOM.integers(1, 1 << 62, 2)]
_LEAST_ID = -(1 << 63)
_PLACE_BITS = 23


class Rolling:
    """Hashes of any parts of a buffer, for one of the bases."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, buf: np.ndarray, which: int):
        up, self.down = self._of(which, len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE[buf] * up[: len(buf)], out=self.sums[1:])

    @classmethod
    def _of(cls, which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of a base and of its inverse modulo 2**64."""
        if which not in cls._powers or len(cls._powers[which][0]) < n:
            held = []
            for base in (_BASE[which], pow(_BASE[which], -1, 1 << 64)):
                power = np.full(max(n, STEP_BYTES), base, np.uint64)
                power[0] = 1
                held.append(np.cumprod(power, dtype=np.uint64))
            cls._powers[which] = held[0], held[1]
        return cls._powers[which]

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.down[a]

    def each(self, k: int) -> np.ndarray:
        """Of every part of ``k`` bytes."""
        return (self.sums[k:] - self.sums[:-k]) * self.down[: len(self.sums) - k]


def _least_in(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    n = len(values) - width + 1
    held, step = values, 1
    while 2 * step <= width:
        held = np.minimum(held[: len(held) - step], held[step:])
        step *= 2
    return np.minimum(held[:n], held[width - step : width - step + n])


def anchored(texts: list[bytes], least: int, k: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(text, start, n, x, full) of the runs of ``n`` neighbouring strings of
    ``least`` bytes with one anchor; ``x`` is the anchor's hash, ``full`` that of all
    bytes of the run and of the anchor's place in it."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    at = segments(np.array([len(t) for t in texts], np.int64))
    count = np.maximum(np.diff(at) - least + 1, 0)
    idx = spread(at[:-1], count)
    if not len(idx):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64))
    text = np.repeat(np.arange(len(texts)), count)
    h = mix(Rolling(buf, 0).each(k))
    # of equal hashes the leftmost, whatever surrounds the string
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    anchor = (_least_in((h & ~mask) | np.arange(len(h), dtype=np.uint64), least - k + 1) & mask).astype(np.int64)[idx]
    first = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    n = np.diff(np.append(first, len(idx)))
    start, anchor, text = idx[first], anchor[first], text[first]
    whole = Rolling(buf, 1)(start, start + n - 1 + least)
    full = mix(whole ^ mix((anchor - start).astype(np.uint64) << np.uint64(32) | n.astype(np.uint64)))
    return text, start - at[text], n, h[anchor].view(np.int64), full.view(np.int64)


def _pieces(text: bytes, least: int) -> Iterator[tuple[int, bytes]]:
    """A text in parts that begin at these places and hold each of its strings once."""
    for a in range(0, max(len(text) - least + 1, 1), STEP_BYTES):
        yield a, text[a : a + STEP_BYTES + least - 1]


_LONGS = {c: pa.int64() for c in ("d", "row", "s", "n")}


def _runs(doc: np.ndarray, s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (document, start, count), sorted, with those that touch as one."""
    if not len(doc):
        return doc, s, n
    first = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (s != np.append(0, (s + n)[:-1])))
    return doc[first], s[first], np.add.reduceat(n, first)


def _order(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' order by the keys, the first one first, and whether a row in that
    order differs from the one before in any of the keys."""
    order = np.lexsort(keys[::-1])
    differs = np.zeros(len(order), bool)
    for k in keys:
        differs |= np.append(True, np.diff(k[order]) != 0)[: len(order)]
    return order, differs


def _firsts(k: np.ndarray, k2: np.ndarray, d: np.ndarray, row: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows with one key, the first by place, and, in the order given, the others.
    Rows that repeat an id and a text aren't earlier than each other: of these only the
    first is told."""
    order, _ = _order(k, k2, d, row, s)
    new = np.append(True, (np.diff(k[order]) != 0) | (np.diff(k2[order]) != 0))[: len(order)]
    one = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = (d[order] != d[one]) | (row[order] != row[one]) | (s[order] != s[one])
    return order[new], np.sort(order[later])


def _spread_by(d: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Keys of runs that go, which meet no other."""
    return mix(s.astype(np.uint64) + (d[0] if len(d) else np.int64(0)).astype(np.uint64)).view(np.int64)


def contexts(docs: DataFrame, least: int) -> DataFrame:
    """(x, full, d, row, s, n, gone): the runs of strings by anchor. Of those that a
    step of a task has twice only the first is there as such; the others are runs
    that go, joined where they touch."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = (batch.column(c).to_numpy() for c in ("d", "row"))
            for a, _, texts in text_steps(batch, "text"):
                parts = [(i, p, t) for i, text in enumerate(texts) for p, t in _pieces(text, least)]
                for part in [parts] if len(texts) > 1 else [[p] for p in parts]:
                    of, s, n, x, full = anchored([t for _, _, t in part], least)
                    doc = np.array([i for i, _, _ in part], np.int64)[of] + a
                    s = s + np.array([p for _, p, _ in part], np.int64)[of]
                    keep, go = _firsts(x, full, ids[doc], rows[doc], s)
                    gd, gs, gn = _runs(doc[go], s[go], n[go])
                    d = np.concatenate((doc[keep], gd))
                    out = [np.concatenate((x[keep], _spread_by(gd, gs))), np.concatenate((full[keep], np.zeros(len(gd), np.int64))), ids[d], rows[d], np.concatenate((s[keep], gs)), np.concatenate((n[keep], gn)), np.arange(len(d)) >= len(keep)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["x", "full", "d", "row", "s", "n", "gone"])

    return docs.select("d", "row", "text").mapInArrow(make, "x long, full long, d long, row long, s long, n long, gone boolean")


def _fetch(batches: Iterator[pa.RecordBatch], least: int, longer: int) -> Iterator[pa.RecordBatch]:
    """Rows of a text and its open runs, with their bytes: each run as it is, or, of hot
    anchors, the runs of its strings by ``longer`` anchors, each once a step."""
    names = ["hot", "k", "k2", "d", "row", "s", "n", "gone", "data"]
    for batch in batches:
        ids, rows = (batch.column(c).to_numpy() for c in ("d", "row"))
        runs = batch.column("runs").to_pylist()
        for a, b, texts in text_steps(batch, "text"):
            cold, hot, parts = [], [], []
            for i, text in zip(range(a, b), texts, strict=True):
                for r in sorted(runs[i], key=lambda r: r["s"]):
                    data = text[r["s"] : r["s"] + r["n"] - 1 + least]
                    if r["hot"]:
                        hot.append((i, r["s"]))
                        parts.append(data)
                    else:
                        cold.append((False, r["x"], 0, ids[i], rows[i], r["s"], r["n"], False, data))
            if cold:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*cold, strict=True)], names)
            # bounded parts, whatever a step holds of them
            cut = np.append(np.flatnonzero(np.diff(np.cumsum([len(p) for p in parts]) // STEP_BYTES, prepend=-1)), len(parts)).tolist()
            for x, y in zip(cut, cut[1:], strict=False):
                of, begin, n, k, k2 = anchored(parts[x:y], least, longer)
                doc, s = (np.array(c, np.int64)[of] for c in zip(*hot[x:y], strict=True))
                s = s + begin
                keep, go = _firsts(k, k2, ids[doc], rows[doc], s)
                gd, gs, gn = _runs(doc[go], s[go], n[go])
                d = np.concatenate((doc[keep], gd))
                data = [parts[x + of[i]][begin[i] : begin[i] + n[i] - 1 + least] for i in keep.tolist()]
                cols = [np.concatenate((k[keep], _spread_by(gd, gs))), np.concatenate((k2[keep], np.zeros(len(gd), np.int64))), ids[d], rows[d], np.concatenate((s[keep], gs)), np.concatenate((n[keep], gn)), np.arange(len(d)) >= len(keep)]
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(d), bool)), *(pa.array(c) for c in cols), pa.array([*data, *[None] * len(gd)], pa.binary())], names)


def _strings(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The hashes of the single strings in runs, each once a step."""
    for batch in batches:
        d, row, s, n = (batch.column(c).to_numpy() for c in _LONGS)
        order, _ = _order(d, row, s)
        size = n[order] - 1 + least
        cut = np.append(np.flatnonzero(np.diff(np.cumsum(size) // STEP_BYTES, prepend=-1)), len(order)).tolist()
        for x, y in zip(cut, cut[1:], strict=False):
            part = order[x:y]
            buf = np.frombuffer(b"".join(batch.column("data").take(pa.array(part)).to_pylist()), np.uint8)
            begin = segments(size[x:y])[:-1]
            at, of = spread(begin, n[part]), np.repeat(np.arange(y - x), n[part])
            k, k2 = (mix(Rolling(buf, w)(at, at + least)).view(np.int64) for w in (0, 1))
            doc, starts = np.cumsum(np.append(False, (np.diff(d[part]) != 0) | (np.diff(row[part]) != 0))), s[part][of] + at - begin[of]
            keep, go = _firsts(k, k2, d[part][of], row[part][of], starts)
            gd, gs, gn = _runs(doc[of[go]], starts[go], np.ones(len(go), np.int64))
            which = part[np.concatenate((of[keep], np.searchsorted(doc, gd)))]
            cols = [np.concatenate((k[keep], _spread_by(gd, gs))), np.concatenate((k2[keep], np.zeros(len(gd), np.int64))), d[which], row[which], np.concatenate((starts[keep], gs)), np.concatenate((np.ones(len(keep), np.int64), gn)), np.arange(len(which)) >= len(keep)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["k", "k2", "d", "row", "s", "n", "gone"])


def _later(strings: list[bytes], ids: list[tuple[int, int, int]], least: int) -> Iterator[tuple[int, int, int, int, None]]:
    """Runs (d, row, s, n, no bytes) of the strings of ``least`` bytes that start earlier, too,
    among contexts that begin at (d, row, s)."""
    of, at, name = classes(strings, least)
    if not len(of):
        return
    d, row, s = (np.array(c, np.int64) for c in zip(*ids, strict=True))
    d, row, s = d[of], row[of], s[of] + at
    order, new = _order(d, row, s)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new)
    first = np.full(int(name.max()) + 1, len(order) + 1, np.int64)
    np.minimum.at(first, name, place)
    go = np.flatnonzero(place > first[name])
    doc, start, n = _runs(of[go], s[go], np.ones(len(go), np.int64))
    for i, a, b in zip(doc.tolist(), start.tolist(), n.tolist(), strict=True):
        yield (*ids[i][:2], a, b, None)


def _resolve(batches: Iterator[pa.RecordBatch], least: int, batch_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows in order of key and place: the runs that go, without bytes, and, with
    theirs, those of hot anchors."""

    def told(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows:
            *longs, data = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in longs), pa.array(data, pa.binary())], [*_LONGS, "data"])

    held: list[bytes] = []
    ids: list[tuple[int, int, int]] = []
    size, at = 0, None
    for batch in batches:
        out = []
        for k, d, row, s, n, state, data in zip(*(batch.column(c).to_pylist() for c in ("k", "d", "row", "s", "n", "state", "data")), strict=True):
            if state == "open":
                # an anchor's contexts are taken together
                if k != at and size >= batch_bytes:
                    out += _later(held, ids, least)
                    held, ids, size = [], [], 0
                at = k
                held.append(data)
                ids.append((d, row, s))
                size += len(data)
            else:
                out.append((d, row, s, n, data if state == "hot" else None))
        yield from told(out)
    if held:
        yield from told(list(_later(held, ids, least)))


def _cut(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs, copies = batch.column("runs").to_pylist(), batch.column("copy").to_pylist()
        for a, b, texts in text_steps(batch, "text"):
            out = []
            for i, text in zip(range(a, b), texts, strict=True):
                spans: list[list[int]] = []
                if copies[i]:
                    spans = [[0, len(text)]] if len(text) >= least else []
                else:
                    for r in sorted((r["s"], r["s"] + r["n"] - 1 + least) for r in runs[i] or []):
                        if spans and r[0] <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], r[1])
                        else:
                            spans.append(list(r))
                edges = [0, *(e for span in spans for e in span), len(text)]
                kept = b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
            n, removed, count, digest, kept = zip(*out, strict=True)
            cols = [batch.column("doc_id").slice(a, b - a), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digest), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, least: int = 100, id_col: str = "doc_id", text_col: str = "text", most_contexts: int = CONTEXTS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): each document without
    the bytes covered by a string of ``least`` bytes (more than ``ANCHOR``) that also
    starts earlier, in a document of smaller id or before in its own; ``n_spans`` are
    the runs of removed bytes, ``kept`` are the others."""
    if least <= ANCHOR:
        raise ValueError(f"strings of more than {ANCHOR} bytes only")
    longer = max(ANCHOR + 1, least - least // 6)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.coalesce("doc_id", F.lit(_LEAST_ID)).alias("d"), F.xxhash64("text").alias("row"), F.col("text").cast("binary").alias("text"))

    same = Window.partitionBy("x", "full").orderBy("d", "row", "s")
    seen = contexts(docs, least).repartition("x").withColumns({"nth": F.row_number().over(same), "place": F.rank().over(same)})
    seen = seen.withColumn("several", F.count(F.when((F.col("nth") == 1) & ~F.col("gone"), 1)).over(Window.partitionBy("x")))
    seen = seen.withColumn("state", F.expr(f"CASE WHEN gone OR place > 1 THEN 'later' WHEN nth = 1 AND several > {most_contexts} THEN 'hot' WHEN nth = 1 AND several > 1 THEN 'open' END"))
    seen = materialise(seen.where("state IS NOT NULL").select("x", "d", "row", "s", "n", "state"), "contexts")

    run = F.struct("x", "s", "n", (F.col("state") == "hot").alias("hot"))
    wanted = seen.where("state <> 'later'").groupBy("d", "row").agg(F.collect_list(run).alias("runs"))
    fetched = docs.join(wanted, ["d", "row"]).select("d", "row", "text", "runs")
    fetched = fetched.mapInArrow(lambda b: _fetch(b, least, longer), "hot boolean, k long, k2 long, d long, row long, s long, n long, gone boolean, data binary")

    same = Window.partitionBy("hot", "k", "k2").orderBy("d", "row", "s")
    again = fetched.repartition("k").withColumns({"nth": F.row_number().over(same), "place": F.rank().over(same)})
    again = again.withColumn("several", F.count(F.when((F.col("nth") == 1) & ~F.col("gone"), 1)).over(Window.partitionBy("hot", "k")))
    # runs of anchors that weren't hot are open already
    again = again.withColumn("state", F.expr(f"CASE WHEN NOT hot THEN 'open' WHEN gone OR place > 1 THEN 'later' WHEN nth = 1 AND several > {most_contexts} THEN 'hot' WHEN nth = 1 AND several > 1 THEN 'open' END"))
    again = again.where("state IS NOT NULL").sortWithinPartitions("hot", "k", "k2", "d", "row", "s").select("k", "d", "row", "s", "n", "state", "data")
    found = materialise(again.mapInArrow(lambda b: _resolve(b, least, batch_bytes), "d long, row long, s long, n long, data binary"), "later")

    strings = found.where("data IS NOT NULL").mapInArrow(lambda b: _strings(b, least), "k long, k2 long, d long, row long, s long, n long, gone boolean")
    strings = strings.withColumn("place", F.rank().over(Window.partitionBy("k", "k2").orderBy("d", "row", "s"))).where("gone OR place > 1")

    narrow = lambda df: df.select(*_LONGS)
    gone = narrow(seen.where("state = 'later'")).unionByName(narrow(found.where("data IS NULL"))).unionByName(narrow(strings))
    runs = gone.groupBy("d", "row").agg(F.collect_list(F.struct("s", "n")).alias("runs"))
    nth = F.row_number().over(Window.partitionBy("d", "row").orderBy("doc_id"))
    held = docs.join(runs, ["d", "row"], "left").withColumn("copy", nth > 1)
    return held.select("doc_id", "text", "runs", "copy").mapInArrow(lambda b: _cut(b, least), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
