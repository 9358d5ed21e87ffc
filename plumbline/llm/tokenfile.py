"""Operator 10: token ids in files of directly addressable codes.

An id is cut into chunks of eight bits, lowest first. Level 0 holds the lowest
chunk of every id, level k the next chunk of the ids that need it. A level's
continuation bitmap says which of its chunks go on; a rank directory (set bits
before each 512-bit block) turns a place in one level into the place in the
next. So any token, or any document's span, is read without decoding what comes
before it.

File: magic, then little-endian int64 (documents, tokens, levels), the document
ids (int64), whether each is null (uint8), the starts (int64, one more than
documents), then per level int64 chunk count, chunks (uint8), bitmap (uint8, least bit first), and
directory (int64 per block).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import filesystem, materialise, scratch, text_steps, write_file
from .token_ids import opened

MAGIC = b"PLDAC001"
BLOCK = 512
_SET = np.array([bin(i).count("1") for i in range(256)], np.int64)


def encode_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap, directory) of each level; at least one level."""
    out, rest = [], ids.astype(np.uint64)
    while True:
        chunk, rest = (rest & np.uint64(255)).astype(np.uint8), rest >> np.uint64(8)
        on = rest > 0
        bits = np.packbits(on, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (BLOCK // 8)))
        held = _SET[bits].reshape(-1, BLOCK // 8).sum(1)
        out.append((chunk, bits, np.concatenate(([0], np.cumsum(held)))[:-1].astype(np.int64)))
        if not on.any():
            return out
        rest = rest[on]


def dump(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> list[bytes]:
    """A file's bytes, in parts."""
    levels = encode_levels(ids)
    starts = np.concatenate(([0], np.cumsum(counts))).astype("<i8")
    parts = [MAGIC, np.array([len(doc_ids), len(ids), len(levels)], "<i8").tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is None for d in doc_ids], np.uint8).tobytes(), starts.tobytes()]
    for chunk, bits, ranks in levels:
        parts += [np.array([len(chunk)], "<i8").tobytes(), chunk.tobytes(), bits.tobytes(), ranks.astype("<i8").tobytes()]
    return parts


class TokenFile:
    """A file of this format in memory; random access to its tokens."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        self.data, self.at = data, 8
        n, self.tokens, levels = (int(x) for x in self._take(3, "<i8"))
        ids = self._take(n, "<i8")
        null = self._take(n, np.uint8)
        self.doc_ids = [None if z else int(d) for d, z in zip(ids, null, strict=True)]
        self.starts = self._take(n + 1, "<i8")
        self.levels = []
        for _ in range(levels):
            count = int(self._take(1, "<i8")[0])
            blocks = -(-count // BLOCK)
            self.levels.append((self._take(count, np.uint8), self._take(blocks * BLOCK // 8, np.uint8), self._take(blocks, "<i8")))

    def _take(self, n: int, kind) -> np.ndarray:
        out = np.frombuffer(self.data, kind, n, self.at)
        self.at += out.nbytes
        return out

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Set bits before place i: one directory entry and at most one block."""
        block = i // BLOCK
        if block >= len(ranks):
            return int(ranks[-1] + _SET[bits[(len(ranks) - 1) * BLOCK // 8 :]].sum()) if len(ranks) else 0
        a = block * BLOCK // 8
        n = int(ranks[block]) + int(_SET[bits[a : i // 8]].sum())
        return n + int(_SET[bits[i // 8] & ((1 << (i % 8)) - 1)])

    def token(self, i: int) -> int:
        """The i-th id of the file."""
        value = 0
        for k, (chunk, bits, ranks) in enumerate(self.levels):
            value |= int(chunk[i]) << (8 * k)
            if not bits[i // 8] >> (i % 8) & 1:
                return value
            i = self._rank(bits, ranks, i)
        return value

    def span(self, a: int, b: int) -> np.ndarray:
        """Ids a to b (without b)."""
        out, who = np.zeros(b - a, np.uint64), np.arange(b - a)
        for k, (chunk, bits, ranks) in enumerate(self.levels):
            if a >= b:
                break
            out[who] |= chunk[a:b].astype(np.uint64) << np.uint64(8 * k)
            on = np.unpackbits(bits[a // 8 : -(-b // 8)], bitorder="little")[a % 8 : a % 8 + b - a].astype(bool)
            who = who[on]
            a = self._rank(bits, ranks, a)
            b = a + len(who)
        return out


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, file_tokens: int = 4_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, append ``end_id``, and write token files below
    ``path`` in ascending order of ``id_col``. Returns the manifest: part, seq,
    path, docs, tokens.

    Null text: only the end id. Null ids come first. Rows with equal ids are
    ordered by a hash of their text and all kept. An empty table gives no file. A
    range partitioning by id and that hash spreads the rows, so that only one text
    repeated under one id can make a task large; a task writes a file each
    ``file_tokens`` tokens and holds no more than that and one batch.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, rows = TaskContext.get().partitionId(), 0, []
        names: list = []
        counts: list[int] = []
        held: list[np.ndarray] = []

        def flush() -> None:
            nonlocal seq
            uri = f"{path}/part-{part:08d}-{seq:06d}.dac"
            ids = np.concatenate(held)
            write_file(uri, dump(names, counts, ids))
            rows.append((part, seq, uri, len(names), len(ids)))
            seq += 1
            names.clear(), counts.clear(), held.clear()

        coder = opened(tokenizer)
        for batch in batches:
            ids_of = batch.column(0)
            for a, _, texts in text_steps(batch, "t", 1 << 20):
                ids, of = coder.encode(texts)
                ends = of[1:]
                held.append(np.insert(ids, ends, end_id))
                names += ids_of.slice(a, len(texts)).to_pylist()
                counts += (np.diff(of) + 1).tolist()
                if sum(map(len, held)) >= file_tokens:
                    flush()
        if names:
            flush()
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["part", "seq", "path", "docs", "tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("h"))
    rows = rows.repartitionByRange("i", "h").sortWithinPartitions("i", "h").select("i", "t")
    return materialise(rows.mapInArrow(write, "part int, seq int, path string, docs long, tokens long"), "tokens-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (over all files, in their
    order), n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, path = filesystem(uri)
                with fs.open_input_stream(path) as f:
                    file = TokenFile(f.read())
                crc = []
                for a, b in zip(file.starts[:-1].tolist(), file.starts[1:].tolist(), strict=True):
                    crc.append(zlib.crc32(file.span(a, b).astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(file.doc_ids, pa.int64()), pa.array(file.starts[:-1] + base), pa.array(np.diff(file.starts)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # sums of whole parts first: the one task without a key has a row for each of them
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("upto"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.join(parts, "part").select("path", (F.col("upto") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).alias("base"))
    n = max(1, min(manifest.count(), 20_000))
    return files.repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None, **options) -> DataFrame:
    """Write the files (to a scratch folder if no ``path`` is given) and read
    every document's span back from them."""
    path = path or scratch(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, path, tokenizer, **options))
