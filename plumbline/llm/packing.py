"""Operator 5: packing documents into sequences of bounded length.

The packing is a cutting-stock problem over the histogram of piece lengths, so
its size depends on the sequence length and not on the corpus. Its
configuration linear program (a column is a multiset of lengths that fits one
sequence) is solved by multiplicative weights: a length that is covered less
gets more weight, and a knapsack dynamic program finds the configuration of the
greatest weight. The fractional solution is rounded; what rounding leaves
is packed best-fit, again on the histogram. The plan is a small table that says
where the r-th piece of a length goes, and a join puts every piece in place.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, text_steps
from .token_ids import opened

#: Ranks within a length are counted in shares of about this many pieces, so that
#: a length with a third of all pieces isn't one task.
SHARE_ROWS = 100_000


def pieces(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces: doc_id, row (tells rows of one id apart), piece, start,
    length, ids_crc32. Only documents longer than ``length`` are cut.

    A null or empty text is the end id alone. The texts stay where they are
    read; only these narrow rows go on.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = opened(tokenizer)
        for batch in batches:
            names, rows = batch.column(0), batch.column(2)
            for a, _, texts in text_steps(batch, "t", 1 << 20):
                ids, of = coder.encode(texts)
                ids = np.insert(ids, of[1:], end_id).astype("<u4")
                of = of + np.arange(len(of))
                size = np.diff(of)
                n = -(-size // length)
                doc = np.repeat(np.arange(len(texts)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * length
                long = np.minimum(length, size[doc] - start)
                begin = of[doc] + start
                crc = [zlib.crc32(ids[b : b + k].tobytes()) for b, k in zip(begin.tolist(), long.tolist(), strict=True)]
                take = pa.array(doc + a)
                yield pa.RecordBatch.from_arrays([names.take(take), rows.take(take), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(long.astype(np.int64)), pa.array(crc, pa.int64())], ["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("h"))
    return rows.mapInArrow(cut, "doc_id long, row long, piece int, start long, length long, ids_crc32 long")


def price(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack by dynamic programming: for each room up to ``capacity``, the
    greatest value of lengths (index = length) that fit, and the last of them (0:
    one place of the room is left empty)."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    sizes = np.flatnonzero(value > 0)
    sizes = sizes[(sizes > 0) & (sizes <= capacity)]
    gain, upto = value[sizes], np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        k = upto[c]
        best[c] = best[c - 1]
        if k:
            got = best[c - sizes[:k]] + gain[:k]
            j = int(got.argmax())
            if got[j] > best[c]:
                best[c], last[c] = got[j], sizes[j]
    return best, last


def configuration(last: np.ndarray, room: int) -> dict[int, int]:
    """The lengths that ``price`` found for a room, with how often each is taken."""
    out: dict[int, int] = defaultdict(int)
    while room > 0:
        if last[room]:
            out[int(last[room])] += 1
        room -= int(last[room]) or 1
    return out


@dataclass
class Program:
    """A solution of the covering program: configurations with how often each is used
    (fractions; no length is covered more than its count), what all pieces need by it
    (those not covered in sequences of their own length), and the greatest lower
    bound that any weights gave."""

    used: dict[tuple, float]
    value: float
    bound: float


def solve_configurations(count: np.ndarray, capacity: int, rounds: int = 40, gap: float = 0.02, rate: float = 0.2, slack: float = 0.02, passes: int = 12) -> Program:
    """Solve the covering program of ``count`` (index = length) in fractions.

    Multiplicative weights: a length's weight starts at its share of a sequence, and
    after each round is multiplied by exp(-rate * c) for the part c of it that the
    round covered. A round fills what it can of all pieces by configurations within
    ``slack`` of the best under its weights: a knapsack program gives the best one that
    has a given length, for each of them; each is used for half of what is left, and
    what is left is priced again, a little higher the more it is. The solution is the
    rounds' average, scaled to where it and the pieces that it doesn't cover need
    least. Any weights bound the program from below by duality: the weight of all
    pieces over that of the best configuration. Rounds end when the solution is within
    ``gap`` of the bound. ``rate`` 0 leaves the weights as they start.
    """
    need, at = count.astype(float), np.arange(len(count))
    each, one = np.maximum(need, 1), need / np.maximum(capacity // np.maximum(at, 1), 1)
    weight = np.where(count > 0, at / capacity, 0.0)
    cover, used, result = np.zeros(len(count)), defaultdict(float), Program({}, float(one.sum()), 0.0)
    best, _ = price(weight, capacity)
    bound = float(need @ weight) / best[capacity] if best[capacity] > 0 else 0.0
    for _ in range(rounds):
        room, done, least = need.copy(), np.zeros(len(count)), 0.0
        for turn in range(passes):
            value = np.where(room > 0, weight * np.exp(slack / 2 * room / each), 0.0)
            best, last = price(value, capacity)
            if best[capacity] <= least:
                break
            if not turn:
                least = (1 - slack) * best[capacity]
                bound = max(bound, float(need @ value) / best[capacity])
            for k in np.flatnonzero((room > 0) & (value + best[np.maximum(capacity - at, 0)] >= least))[::-1].tolist():
                if room[k] <= 0:
                    continue
                pick = configuration(last, capacity - k)
                pick[k] += 1
                m = min(room[j] / n for j, n in pick.items()) * (1.0 if turn == passes - 1 else 0.5)
                if m > 0:
                    used[tuple(sorted(pick.items(), reverse=True))] += m
                    for j, n in pick.items():
                        done[j] += m * n / need[j]
                        room[j] = room[j] - m * n if room[j] - m * n > 1e-3 * need[j] else 0.0
        cover += done
        weight = weight * np.exp(-rate * done)
        weight /= max(weight.max(), 1e-300)
        # what is needed is convex in the scale, with corners where a length is covered
        total = sum(used.values())
        scales = np.unique(1 / cover[cover > 0])
        if len(scales):
            needs = [s * total + float((np.maximum(0, 1 - s * cover) * one).sum()) for s in scales.tolist()]
            k = int(np.argmin(needs))
            if needs[k] < result.value:
                result = Program({key: m * float(scales[k]) for key, m in used.items()}, needs[k], bound)
        if result.value <= (1 + gap) * bound:
            break
    return Program(result.used, result.value, bound)


def rounded(used: dict[tuple, float], count: np.ndarray) -> dict[tuple, int]:
    """A solution in whole numbers that cover no length more than its count: every use
    rounded down, then once more for those that lose most by it, while they fit."""
    left, out = count.copy(), {}

    def take(key: tuple, m: int) -> None:
        m = min([m, *(int(left[k]) // n for k, n in key)])
        if m > 0:
            out[key] = out.get(key, 0) + m
            for k, n in key:
                left[k] -= m * n

    for key, m in used.items():
        take(key, int(m + 1e-6))
    for key, _ in sorted(used.items(), key=lambda x: (-((x[1] + 1e-6) % 1), x[0])):
        take(key, 1)
    return out


def best_fit(count: np.ndarray, capacity: int) -> dict[tuple, int]:
    """Best-fit decreasing on a histogram; equal bins are handled together."""
    bins: dict[int, dict[tuple, int]] = defaultdict(dict)

    def put(room: int, key: tuple, n: int) -> None:
        bins[room][key] = bins[room].get(key, 0) + n

    for size in np.flatnonzero(count)[::-1].tolist():
        n = int(count[size])
        while n:
            room = min((r for r, held in bins.items() if r >= size and held), default=None)
            if room is None:
                fit = capacity // size
                if n >= fit:
                    put(capacity - fit * size, ((size, fit),), n // fit)
                if n % fit:
                    put(capacity - n % fit * size, ((size, n % fit),), 1)
                break
            key, m = bins[room].popitem()
            # several of this size may go into one of these bins
            fit = min(room // size, n)
            full, rest = min(m, n // fit), 0
            if not full:
                full, fit = 1, n
            grown = dict(key)
            grown[size] = grown.get(size, 0) + fit
            put(room - fit * size, tuple(sorted(grown.items(), reverse=True)), full)
            rest = m - full
            if rest:
                put(room, key, rest)
            n -= full * fit
    out: dict[tuple, int] = defaultdict(int)
    for held in bins.values():
        for key, m in held.items():
            out[key] += m
    return dict(out)


@dataclass(frozen=True)
class Plan:
    """Configurations with how many sequences have each, the program's lower bound on
    their number, what its solution needs in fractions, and how many pieces it placed
    (the others: best-fit)."""

    configurations: list[tuple[tuple, int]]
    bound: int
    value: float
    by_program: int


def plan(histogram: dict[int, int], capacity: int, rounds: int = 40) -> Plan:
    """A packing of exactly the histogram: the program's solution, rounded, and what
    that leaves by best-fit. Pieces that fill a sequence are sequences of their own."""
    count = np.zeros(capacity + 1, np.int64)
    for k, n in histogram.items():
        count[k] = n
    out: dict[tuple, int] = defaultdict(int)
    full = int(count[capacity])
    if full:
        out[((capacity, 1),)] += full
    left = count.copy()
    left[capacity] = 0
    program = solve_configurations(left, capacity, rounds)
    by_program = 0
    for key, m in rounded(program.used, left).items():
        out[key] += m
        for k, n in key:
            left[k] -= m * n
            by_program += m * n
    for key, m in best_fit(left, capacity).items():
        out[key] += m
    return Plan(sorted(out.items(), reverse=True), full + math.ceil(program.bound - 1e-6), full + program.value, by_program)


def plan_rows(configurations: list[tuple[tuple, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, pieces of this
    length a sequence, offset of the first) for each part of a configuration."""
    rows, rank, sequence = [], defaultdict(int), 0
    for key, m in configurations:
        offset = 0
        for size, n in key:
            rows.append((size, rank[size], rank[size] + m * n, sequence, n, offset))
            rank[size] += m * n
            offset += size * n
        sequence += m
    return rows


def pack_pieces(cut: DataFrame, length: int = 2048, rounds: int = 40) -> DataFrame:
    """Put every piece into a sequence: adds sequence_id and offset.

    The driver holds the histogram (at most ``length`` rows) and the plan (at most a
    configuration for each length and round), neither of which grows with the
    corpus. A length's pieces are ranked in shares of about ``SHARE_ROWS``; ties of
    one length are broken by doc_id, text hash and piece.
    """
    spark = cut.sparkSession
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    rows = plan_rows(plan(histogram, length, rounds).configurations)
    parts = spark.createDataFrame([(k, -(-n // SHARE_ROWS)) for k, n in histogram.items()], "length long, _parts long")
    # at most a row for each length
    cut = cut.join(F.broadcast(parts), "length").withColumn("_share", F.pmod(F.xxhash64("doc_id", "row", "piece"), F.col("_parts"))).drop("_parts")
    sized = cut.groupBy("length", "_share").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    before = materialise(sized.select("length", "_share", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")), "shares")
    by_rank = Window.partitionBy("length", "_share").orderBy("doc_id", "row", "piece", "ids_crc32")
    ranked = cut.withColumn("_n", F.row_number().over(by_rank) - 1).join(before, ["length", "_share"]).withColumn("_rank", F.col("_n") + F.col("_before"))
    slots = spark.createDataFrame(rows, "length long, _from long, _to long, _sequence long, _each long, _offset long")
    # a piece finds the plan row of its length that holds its rank in a list
    listed = materialise(slots.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("_from", "_to", "_sequence", "_each", "_offset"))).alias("_slots")), "slots")
    out = ranked.join(listed, "length").withColumn("_slot", F.element_at(F.filter("_slots", lambda s: (F.col("_rank") >= s["_from"]) & (F.col("_rank") < s["_to"])), 1)).select("*", "_slot.*")
    inside = F.col("_rank") - F.col("_from")
    return out.withColumns({"sequence_id": F.col("_sequence") + F.floor(inside / F.col("_each")), "offset": F.col("_offset") + F.pmod(inside, F.col("_each")) * F.col("length")}).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0, rounds: int = 40, **columns) -> DataFrame:
    """Pack whole documents into sequences of at most ``length`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. Every token of every document, with its end id, is in exactly one
    sequence. Repeated rows are packed each; a null doc_id is kept; an empty
    table gives no row.
    """
    cut = materialise(pieces(docs, tokenizer, length, end_id, **columns), "pieces")
    return pack_pieces(cut, length, rounds)
