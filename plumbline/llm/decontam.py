"""Operator 2: benchmark decontamination under edits.

A random walk (CGK) reads a string one character at a time and, by a random bit
for each step and character, stays or moves on; what it reads is an embedding in
which few edits become few differing places. Bit sampling keeps some places of
the embedding as a key, several times for each of several independent walks.
Every window of a document that begins at a word (or, in scripts without spaces,
at any character) is walked and looked up among the windows of the benchmark
items; for short items also backward from the ends of words, so that edits in an
item's first word don't hide it. Windows are item-sized up to 64 places: over
longer walks the edits of an item add up until no place agrees, so longer items
have a window at each of their words. A window goes on only while some item
shares its sampled places. What agrees is verified: the item's 64 characters around
the window by an edit distance of many pairs at once, then the whole item by its
exact edit distance to the place in the document.

Texts are compared in lower case with runs of other than letters and digits as
one space.
"""

from __future__ import annotations

import functools
import operator
import pickle
import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filesystem, materialise, scratch, text_steps, write_file
from .words import spread

_SOLID = np.zeros(256, bool)
_SOLID[48:58] = _SOLID[97:123] = _SOLID[128:] = True
#: Characters of two bytes that are signs.
_SIGN = np.array([unicodedata.category(chr(c))[0] not in "LMN" for c in range(0x800)])
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """``share``: edits allowed per character of an item, rounded down.

    A window is as long as the item, to 8, 16, 32 or at most ``steps`` places of the
    walk. It is walked ``walks`` times; ``early`` of its first ``prefix`` places
    are sampled once and ``late`` of the others ``samples`` times, and each of these
    samples with the early places is a key. Tests measure that this finds at least
    nine in ten of items of 2 to 60 words at every number of edits that is accepted.
    """

    share: float = 0.2
    steps: int = 64
    walks: int = 12
    prefix: int = 24
    early: int = 11
    late: int = 4
    samples: int = 6
    seed: int = 29
    #: Bytes of benchmark text that one pass over the documents holds; its index is up
    #: to 250 times that and 20 MB for each of at most seven kinds of windows.
    block_bytes: int = 512 << 10


def normalise(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The normalised texts in one buffer, each after and before a space, and
    where each begins (with the end)."""
    low = [t.decode("utf-8", "replace").lower().encode() for t in texts]
    buf = np.frombuffer(b" ".join([b"", *low, b""]), np.uint8).copy()
    at = np.zeros(len(low) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in low], out=at[1:])
    buf[~_SOLID[buf]] = 32
    keep = np.ones(len(buf), bool)
    keep[1:] = (buf[1:] != 32) | (buf[:-1] != 32)
    keep[at] = True  # the space between two texts stays
    place = np.concatenate(([0], np.cumsum(keep)))
    return buf[keep], place[at]


#: Characters are walked as 32 classes: letters, digits by remainder, others by byte.
CLASS = np.zeros(256, np.uint8)
CLASS[97:123] = np.arange(1, 27)
CLASS[48:58] = 27 + np.arange(10) % 5
CLASS[128:] = np.arange(128) * 7 % 32


def window_ends(buf: np.ndarray) -> np.ndarray:
    """Where backward windows begin in normalised text: the mirror of ``window_starts``."""
    after = np.concatenate((buf[1:], np.array([32], np.uint8)))
    high = buf > 127
    return np.flatnonzero((buf != 32) & ((after == 32) | high & np.concatenate((~high[1:], [True])) | high & ((after & 0xC0) != 0x80)))


def window_starts(buf: np.ndarray) -> np.ndarray:
    """Where windows begin in normalised text: at words, at every character from
    U+0800 on (scripts without spaces are there) and every other sign that is
    neither letter nor number, and after those."""
    before = np.concatenate((np.array([32], np.uint8), buf[:-1]))
    if not (buf > 127).any():
        return np.flatnonzero((before == 32) & (buf != 32))
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    c, then = buf[at].astype(np.int64), buf[np.minimum(at + 1, len(buf) - 1)]
    apart = (c >= 0xE0) | (c >= 0xC0) & _SIGN[(c & 31) << 6 | then & 63]
    after = np.concatenate(([False], apart[:-1]))
    return at[(c != 32) & ((before[at] == 32) | apart | after)]


def edits_within(item: bytes, text: bytes, most: int) -> int | None:
    """Least edit distance of ``item`` to any part of ``text``, if it is at most
    ``most``: dynamic programming with a column as bits of one integer."""
    if item in text:
        return 0
    n = len(item)
    full, top = (1 << n) - 1, 1 << (n - 1)
    where: dict[int, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    up, down, score, best = full, 0, n, n
    for c in text:
        eq = where.get(c, 0)
        x = eq | down
        d = ((x & up) + up ^ up) | x
        plus, minus = down | (full & ~(d | up)), up & d
        score += 1 if plus & top else -1 if minus & top else 0
        best = min(best, score)
        # a part may begin anywhere: nothing is carried into the first row
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | (full & ~(d | plus)), plus & d
    return best if best <= most else None


def edits_of_many(flat: np.ndarray, at: np.ndarray, size: np.ndarray, buf: np.ndarray, begin: np.ndarray, length: np.ndarray, step: int = 4096) -> np.ndarray:
    """Least edit distance of each piece ``flat[at : at + size]`` of at most 64
    characters to any part of ``buf[begin : begin + length]``: dynamic programming
    with a column as the bits of one number, for many pairs at once."""
    out = size.astype(np.int64)
    one = np.uint64(1)
    for a in range(0, len(at), step):
        n = size[a : a + step].astype(np.uint64)
        piece = flat[at[a : a + step, None] + np.arange(64)]
        top = one << (n - one)
        up, down = np.full(len(n), ~np.uint64(0)), np.zeros(len(n), np.uint64)
        score = best = n.astype(np.int64)
        start, many = begin[a : a + step], length[a : a + step]
        for j in range(int(many.max(initial=0))):
            c = buf[np.minimum(start + j, len(buf) - 1)]
            eq = np.packbits(piece == c[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
            x = eq | down
            d = ((x & up) + up ^ up) | x
            plus, minus = down | ~(d | up), up & d
            score = score + ((plus & top) > 0) - ((minus & top) > 0)
            best = np.where(j < many, np.minimum(best, score), best)
            # a part may begin anywhere: nothing is carried into the first row
            plus, minus = plus << one, minus << one
            up, down = minus | ~(d | plus), plus & d
        out[a : a + step] = best
    return out


class Walk:
    """One random walk over classes of characters, forward or backward, with
    places sampled early and several samples of later ones."""

    def __init__(self, steps: int, s: Settings, seed: int, back: bool) -> None:
        rng = np.random.Generator(np.random.PCG64([seed, steps, back]))
        self.steps, self.way = steps, -1 if back else 1
        self.move = rng.integers(0, 2, (steps, 32), dtype=np.int64)
        self.early_end = max(s.prefix * steps // s.steps, min(steps, 6))
        # the first four places tell windows apart at least cost
        more = 4 + rng.choice(self.early_end - 4, (s.early if steps == s.steps else min(s.early, 5)) - 4, replace=False)
        early = np.concatenate((np.arange(4), more))
        self.early = np.isin(np.arange(steps), early)
        rest = steps - self.early_end
        late = [self.early_end + rng.choice(rest, -(-s.late * steps // s.steps), replace=False) for _ in range(s.samples * (1 if steps == s.steps else 2))]
        self.late = [np.isin(np.arange(steps), x) for x in late]
        self.checks = {self.early_end // 2, 3 * self.early_end // 4, self.early_end}

    def read(self, key: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (key + c + np.uint64(1)) * _MULTIPLY

    def keys(self, buf: np.ndarray, starts: np.ndarray, known: dict[int, np.ndarray] | None = None, out: dict[int, np.ndarray] | None = None) -> tuple[list[np.ndarray], np.ndarray]:
        """Keys of the windows at ``starts`` for each sample, with their starts.
        ``known``: of some steps, a bit table of the items' keys, which a window must
        have to go on; ``out`` gathers the keys of all early steps, sorted."""
        pos, key = starts.copy(), np.zeros(len(starts), np.uint64)
        keys: list[np.ndarray] = []
        for j in range(self.steps):
            if out is not None and j <= self.early_end:
                out[j] = np.unique(key)
            elif known is not None and j in self.checks:
                go = has_bit(known[j], key)
                pos, key, starts = pos[go], key[go], starts[go]
            if j == self.early_end:
                keys = [key.copy() for _ in self.late]
            c = buf[pos]
            if self.early[j]:
                key = self.read(key, c)
            for k, late in enumerate(self.late):
                if late[j]:
                    keys[k] = self.read(keys[k], c)
            pos += self.way * self.move[j][c]
        return keys or [key for _ in self.late], starts

    def alive(self, known: dict[int, np.ndarray]) -> np.ndarray:
        """Codes of four characters with which a window may have an item's early keys."""
        code, step, key = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.uint64)
        for n in range(4):
            c = np.tile(np.arange(32), len(code))
            code, step, key = (np.repeat(x, 32) for x in (code, step, key))
            code |= c << 5 * n
            open_ = np.flatnonzero(step < self.early_end)
            while len(open_):
                at, sign = step[open_], c[open_]
                key[open_] = np.where(self.early[at], self.read(key[open_], sign.astype(np.uint64)), key[open_])
                step[open_] += 1
                open_ = open_[(self.move[at, sign] == 0) & (at + 1 < self.early_end)]
            go = np.zeros(len(code), bool)
            for j in np.unique(step).tolist():
                mine = step == j
                go[mine] = is_in(key[mine], known[j])
            code, step, key = code[go], step[go], key[go]
        return code


def is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether values are among sorted ones."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def bit_table(keys: np.ndarray) -> np.ndarray:
    """A bit for each value of the highest bits of keys: 20 of them, or fewer where
    there are few keys, but at least 128 bits a key."""
    wide = min(20, max(10, (128 * len(keys)).bit_length()))
    held = np.zeros(1 << wide, bool)
    held[(keys >> np.uint64(64 - wide)).astype(np.int64)] = True
    return np.packbits(held, bitorder="little")


def has_bit(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    spot = (keys >> np.uint64(65 - (8 * len(table)).bit_length())).astype(np.int64)
    return (table[spot >> 3] >> (spot & 7).astype(np.uint8) & 1).astype(bool)


#: Pairs of a window and an item window that are listed at once.
PAIRS = 1 << 19


def distinct(*columns: np.ndarray) -> np.ndarray:
    """Places of the first of each different row, in order of the rows."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        new |= np.append(True, np.diff(c[order]) != 0)[: len(order)]
    return order[new]


@dataclass
class Windows:
    """Item windows of one size and direction: a table of the first four
    characters, with a bit for each walk that may go on, and each walk's keys."""

    steps: int
    back: bool
    table: np.ndarray
    walks: list[tuple[Walk, dict[int, np.ndarray], list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]]


class Index:
    """The benchmark windows of some items, by walk, sample and key."""

    def __init__(self, items: list[tuple[int | None, bytes]], s: Settings) -> None:
        self.s = s
        self.ids = [i for i, _ in items]
        buf, at = normalise([t for _, t in items])
        raw = buf.tobytes()
        self.texts = [raw[a:b].strip(b" ") for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        size = self.size = np.array([len(t) for t in self.texts], np.int64)
        #: Starts of an item that are no further apart are one candidate, and so are
        #: windows of an item with one key: half of its edits, at most eight, so that what
        #: repeats in an item and a text isn't listed in all pairs. Searches reach that
        #: far more.
        self.step = np.clip((s.share * size).astype(np.int64) // 2, 1, 8)
        self.flat, self.first = np.frombuffer(b"".join(self.texts) + bytes(64), np.uint8), np.cumsum(size) - size
        #: Items too short for a walk, by the number that their bytes are.
        self.tiny: dict[int, dict[int, list[int]]] = {}
        for i in np.flatnonzero((size > 0) & (size < 8)).tolist():
            self.tiny.setdefault(len(self.texts[i]), {}).setdefault(int.from_bytes(self.texts[i] + b" ", "little"), []).append(i)
        self.groups = []
        for steps, below in ((8, 16), (16, 32), (32, s.steps), (s.steps, 1 << 62)):
            mine = np.flatnonzero((size >= steps) & (size < below))
            if len(mine):
                self.groups += [self._windows(mine, steps, back) for back in ((False, True) if steps < s.steps else (False,))]

    def _windows(self, mine: np.ndarray, steps: int, back: bool) -> Windows:
        own = np.frombuffer(b" " + b" ".join([self.texts[i] for i in mine] + [b""]), np.uint8)
        first = 1 + np.cumsum([0, *(len(self.texts[i]) + 1 for i in mine)])
        word = window_ends(own) if back else window_starts(own)
        item = np.searchsorted(first, word, "right") - 1
        # windows that are whole in the item
        inside = word - steps >= first[item] - 1 if back else word + steps <= first[item + 1] - 1
        word, item = word[inside], item[inside]
        held = np.concatenate((CLASS[own], np.zeros(steps + 1, np.uint8)))
        out = Windows(steps, back, np.zeros(1 << 20, np.uint32), [])
        for w in range(self.s.walks):
            walk, early = Walk(steps, self.s, self.s.seed + w, back), {}
            keys, _ = walk.keys(held, word, out=early)
            early.setdefault(walk.early_end, np.unique(keys[0]))
            out.table[walk.alive(early)] |= np.uint32(1 << w)
            offset = word - first[item]
            order = [distinct(k, item, offset // self.step[mine[item]]) for k in keys]
            tables = [(k[o], mine[item[o]].astype(np.int32), offset[o].astype(np.int32), bit_table(k)) for k, o in zip(keys, order, strict=True)]
            out.walks.append((walk, {j: bit_table(early[j]) for j in walk.checks}, tables))
        return out

    def candidates(self, buf: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """(text, start of the item, item) suggested by agreeing keys, in order of text,
        item and start; of starts in one ``step`` of an item the first found.

        ``texts``: where each text begins. The text is that of the window, since
        an item whose beginning is missing may seem to start before it.
        """
        found: list[np.ndarray] = []
        room = self.s.steps + 5
        held = np.concatenate((np.zeros(room, np.uint8), CLASS[buf], np.zeros(room, np.uint8)))
        ends = {}
        for g in self.groups:
            if g.back not in ends:
                at = (window_ends(buf) if g.back else window_starts(buf)) + room
                way = -1 if g.back else 1
                four = (held[at + way * n].astype(np.int64) << 5 * n for n in range(4))
                ends[g.back] = at, functools.reduce(operator.or_, four)
            at, code = ends[g.back]
            mask = g.table[code]
            at, mask = at[mask > 0], mask[mask > 0]
            for w, (walk, early, tables) in enumerate(g.walks):
                keys, where = walk.keys(held, at[(mask >> np.uint32(w) & np.uint32(1)) > 0], known=early)
                for key, (known, item, offset, table) in zip(keys, tables, strict=True):
                    go = has_bit(table, key)
                    key, at_key = key[go], where[go]
                    a, b = np.searchsorted(known, key, "left"), np.searchsorted(known, key, "right")
                    # a frequent key in bounded parts, each reduced before the next
                    cuts = np.append(np.flatnonzero(np.diff(np.cumsum(b - a) // PAIRS, prepend=-1)), len(a)).tolist()
                    for x, y in zip(cuts, cuts[1:], strict=False):
                        k, n = spread(a[x:y], (b - a)[x:y]), (b - a)[x:y]
                        place = np.repeat(at_key[x:y], n) - room
                        found.append(self._apart(np.stack((np.searchsorted(texts, place, "right") - 1, place - offset[k], item[k], offset[k]), 1)))
                    if sum(map(len, found)) > 4 * PAIRS:
                        found = [self._apart(np.concatenate(found))]
        if not found:
            return np.zeros((0, 3), np.int64)
        every = self._apart(np.concatenate(found))
        every = every[self._near(buf, texts, every), :3]
        return every[np.lexsort((every[:, 1], every[:, 2], every[:, 0]))]

    def _apart(self, found: np.ndarray) -> np.ndarray:
        """One candidate for each text, item and ``step`` of starts."""
        text, begin, item, _ = found.T
        spot = begin // self.step[item] + 1_000_000_000  # a start may lie before the text
        if not len(text) or (int(text.max()) + 1) * len(self.size) * 2 * int(spot.max() - spot.min() + 1) >= 1 << 62:
            return found[distinct(text, item, spot)]
        one = (text * len(self.size) + item) * int(spot.max() - spot.min() + 1) + spot - spot.min()
        return found[np.unique(one, return_index=True)[1]]

    def _near(self, buf: np.ndarray, texts: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Which candidates agree well enough with the at most 64 characters of the
        item around their window: exact for items that are no longer."""
        text, begin, item, offset = found.T
        size = self.size[item]
        most = (self.s.share * size).astype(np.int64)
        low = np.clip(offset - 16, 0, np.maximum(size - 64, 0))
        long = np.minimum(size, 64)
        slack = np.minimum(most, 28)
        reach = slack + 2 * self.step[item]
        a = np.maximum(begin + low - reach, texts[text])
        b = np.minimum(begin + low + long + reach, texts[text + 1])
        got = edits_of_many(self.flat, self.first[item] + low, long, buf, a, np.maximum(b - a, 0))
        return got <= np.where(size <= 64, most, np.maximum(slack, 28))

    def whole_words(self, buf: np.ndarray, texts: np.ndarray) -> list[tuple[int, int]]:
        """(text, item) of the items of fewer than eight characters that stand in a
        text as whole words."""
        if not self.tiny:
            return []
        at = window_starts(buf)
        held = np.concatenate((buf, np.full(8, 32, np.uint8)))
        eight = np.lib.stride_tricks.as_strided(held[:8].view("<u8"), (len(buf) + 1,), (1,))[at]
        out = set()
        for n, items in self.tiny.items():
            value = eight & np.uint64((1 << 8 * (n + 1)) - 1)
            hit = np.flatnonzero(is_in(value, np.array(sorted(items), np.uint64)))
            for i in hit.tolist():
                text = int(np.searchsorted(texts, at[i], "right")) - 1
                out |= {(text, item) for item in items[int(value[i])]}
        return sorted(out)


def matches(texts: list[bytes], index: Index) -> list[tuple[int, int, int]]:
    """(text, item, edits) of the items found in whole texts, fewest edits."""
    buf, at = normalise(texts)
    best: dict[tuple[int, int], int | None] = dict.fromkeys(index.whole_words(buf, at), 0)
    raw = buf.tobytes()
    found = index.candidates(buf, at)
    text, begin, item = found.T
    most, size, more = (index.s.share * index.size[item]).astype(np.int64), index.size[item], 2 * index.step[item]
    low, high = np.maximum(at[text], begin - most - more), np.minimum(at[text + 1], begin + 2 * most + size + more)
    # places of an item that overlap are looked at as one
    upto = -1
    parts: list[list[int]] = []
    for d, i, a, b in zip(text.tolist(), item.tolist(), low.tolist(), high.tolist(), strict=True):
        if parts and parts[-1][:2] == [d, i] and a <= upto:
            parts[-1][3] = upto = max(upto, b)
        else:
            parts.append([d, i, a, b])
            upto = b
    for d, i, a, b in parts:
        own = index.texts[i]
        edits = int(index.s.share * len(own))
        if best.get((d, i)) == 0 or b - a < len(own) - edits:
            continue
        got = edits_within(own, raw[a:b], edits)
        if got is not None and (best.get((d, i)) is None or got < best[d, i]):
            best[d, i] = got
    return [(d, i, e) for (d, i), e in best.items() if e is not None]


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, item_id, edits): documents and the items in them; ``row``
    tells rows of one id apart.

    The benchmark is dealt to blocks of bounded size; tasks build the index of each,
    in shared files that the searching tasks read. A block is one pass over all
    documents, which are not shuffled. Null or empty texts match nothing; items of
    fewer than eight normalised characters match their exact copies as whole words,
    those without a letter or digit nothing; repeated rows match alike; an empty
    table of either kind gives no rows.
    """
    s = settings or Settings()
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t"))
    out = docs.sparkSession.createDataFrame([], "doc_id long, row long, item_id long, edits int")

    def search(path: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = None
            for batch in batches:
                index = index or _read(path)
                for a, _, texts in text_steps(batch, "t"):
                    got = matches(texts, index)
                    take = pa.array([a + d for d, _, _ in got], pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array([index.ids[i] for _, i, _ in got], pa.int64()), pa.array([e for _, _, e in got], pa.int32())], ["doc_id", "row", "item_id", "edits"])

        return run

    for path in indexes(benchmark, s):
        out = out.union(rows.mapInArrow(search(path), out.schema))
    return out


def indexes(benchmark: DataFrame, s: Settings) -> list[str]:
    """Files of the indexes of all items, each of up to ``block_bytes`` of text."""
    folder = scratch(benchmark.sparkSession, "benchmark")
    items = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def write() -> pa.RecordBatch:
            path = f"{folder}/{uuid.uuid4().hex}.index"
            write_file(path, [pickle.dumps(Index(held, s), pickle.HIGHEST_PROTOCOL)])
            return pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
                if held and size + len(text) > s.block_bytes:
                    yield write()
                    held, size = [], 0
                held.append((i, text))
                size += len(text)
        if held:
            yield write()

    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    built = items.repartition(max(1, -(-total // s.block_bytes))).mapInArrow(build, "path string")
    # one short row a block
    return sorted(r["path"] for r in materialise(built, "benchmark-index").collect())


def _read(path: str) -> Index:
    fs, at = filesystem(path)
    with fs.open_input_stream(at) as f:
        return pickle.loads(f.read())


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``docs`` without those that hold a benchmark item."""
    found = contaminated(docs, benchmark, settings).select(F.col("doc_id").alias("_i"), F.col("row").alias("_h")).distinct()
    found = materialise(found, "contaminated")
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found["_i"]) & F.xxhash64(docs["text"]).eqNullSafe(found["_h"]), "left_anti")
