"""Operator 7: baseline JPEG in numpy: stored samples, and DC-only thumbnails.

Decoding works on many images of a batch at once. A scan is cut at its restart
markers; all segments are then Huffman-decoded in step, one symbol of every
segment at a time, by a 16-bit table lookup. DC coefficients alone give a
luminance image of one sample per block, from which the feature is computed.

Payloads are stored losslessly as quantised coefficients, 64 bytes a block, each
byte as the value byte + 256 (all of size category 9), with a restart marker
after every block. Any baseline decoder reads the coefficients back unchanged.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_steps
from .words import segments

#: Payload bytes come in multiples of this: nine blocks of 64.
UNIT = 576


def _zigzag() -> np.ndarray:
    """Natural index of each place in zigzag order."""
    cells = sorted(((r + c, r if (r + c) % 2 else c, r, c) for r in range(8) for c in range(8)))
    return np.array([r * 8 + c for _, _, r, c in cells])


ZIGZAG = _zigzag()


# -- storing -----------------------------------------------------------------


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">HH", marker, len(body) + 2) + body


def _head(width: int, height: int, payload: int) -> bytes:
    one = bytes([1, *[0] * 15])  # one code of one bit
    return b"".join((
        b"\xff\xd8",
        _segment(0xFFFE, b"payload=%d" % payload),
        _segment(0xFFDB, bytes([0]) + bytes([1]) * 64),
        _segment(0xFFC0, struct.pack(">BHHBBBB", 8, height, width, 1, 1, 0x11, 0)),
        _segment(0xFFC4, bytes([0x00]) + one + bytes([9])),
        _segment(0xFFC4, bytes([0x10]) + one + bytes([9])),
        _segment(0xFFDD, struct.pack(">H", 1)),
        _segment(0xFFDA, bytes([1, 1, 0x00, 0, 63, 0])),
    ))


def shape(blocks: int) -> tuple[int, int]:
    """Blocks across and down; a multiple of nine across, at least ``blocks``."""
    across = 9 * max(1, -(-blocks // (9 * 8191)))
    return across, -(-blocks // across)


def pad(text: bytes) -> bytes:
    """Bytes 255 up to a positive multiple of the unit."""
    return text + b"\xff" * (UNIT if not text else -len(text) % UNIT)


def store(payloads: list[bytes]) -> list[bytes]:
    """A JPEG for each payload (each a positive multiple of the unit)."""
    sizes, padded = [], []
    for p in payloads:
        across, down = shape(len(p) // 64)
        sizes.append((across, down))
        padded.append(p + b"\xff" * (across * down * 64 - len(p)))
    values = np.frombuffer(b"".join(padded), np.uint8)
    # four coefficients are four times a 0 bit and nine bits 1xxxxxxxx: byte + 256
    v = values.reshape(-1, 4).astype(np.uint64) + np.uint64(256)
    word = v[:, 0] << np.uint64(30) | v[:, 1] << np.uint64(20) | v[:, 2] << np.uint64(10) | v[:, 3]
    scan = word.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].reshape(-1, 80)
    n = len(scan)
    marked = np.empty((n, 82), np.uint8)
    marked[:, :80] = scan
    marked[:, 80] = 255
    first = segments(np.array([a * d for a, d in sizes]))
    marked[:, 81] = 0xD0 + (np.arange(n) - np.repeat(first[:-1], np.diff(first))) % 8
    marked[first[1:] - 1, 81] = 0xD9  # the last one ends the image
    flat = marked.reshape(-1)
    stuff = flat == 255
    stuff[80::82] = False
    shift = np.cumsum(stuff)
    out = np.zeros(len(flat) + int(shift[-1]), np.uint8)
    shift -= stuff
    out[np.arange(len(flat)) + shift] = flat
    ends = np.concatenate(([0], first[1:] * 82 + shift[np.minimum(first[1:] * 82, len(flat)) - 1] + stuff[first[1:] * 82 - 1]))
    body = out.tobytes()
    return [_head(a * 8, d * 8, len(p)) + body[ends[i] : ends[i + 1]] for i, ((a, d), p) in enumerate(zip(sizes, payloads, strict=True))]


# -- decoding ----------------------------------------------------------------


def _table(counts: bytes, symbols: bytes) -> np.ndarray:
    """For each 16 bits that may come next: code length * 256 + symbol (0: none)."""
    out, code, k = np.zeros(1 << 16, np.int32), 0, 0
    for length in range(1, 17):
        for _ in range(counts[length - 1]):
            a = code << (16 - length)
            out[a : a + (1 << (16 - length))] = length * 256 + symbols[k]
            code, k = code + 1, k + 1
        code <<= 1
    return out


def parse(data: bytes) -> dict | None:
    """Markers of a baseline JPEG: sizes, components, tables, scan. None if it
    isn't one or is cut short."""
    try:
        if data[:2] != b"\xff\xd8":
            return None
        out: dict = {"quant": {}, "tables": {}, "restart": 0, "comment": b""}
        at = 2
        while True:
            if data[at] != 255:
                return None
            marker, n = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            if marker == 255:
                at += 1
                continue
            body = data[at + 4 : at + 2 + n]
            if marker == 0xDB:
                while body:
                    wide, k = body[0] >> 4, body[0] & 15
                    size = 64 * (1 + wide)
                    out["quant"][k] = np.frombuffer(body[1 : 1 + size], ">u2" if wide else "u1").astype(np.int32)
                    body = body[1 + size :]
            elif marker == 0xC4:
                while body:
                    m = sum(body[1:17])
                    out["tables"][body[0]] = (body[1:17], body[17 : 17 + m])
                    body = body[17 + m :]
            elif marker == 0xC0:
                _, out["height"], out["width"], k = struct.unpack(">BHHB", body[:6])
                out["parts"] = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(k)]
            elif marker in (0xC1, 0xC2, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
                return None
            elif marker == 0xDD:
                out["restart"] = int.from_bytes(body[:2], "big")
            elif marker == 0xFE:
                out["comment"] = body
            elif marker == 0xDA:
                use = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
                if len(use) != len(out["parts"]) or not out["width"] or not out["height"]:
                    return None
                # one list entry for each block of an MCU: component, DC and AC table
                alone = len(use) == 1
                out["mcu"] = tuple((c, use[p[0]] >> 4, 16 + (use[p[0]] & 15)) for c, p in enumerate(out["parts"]) for _ in range(1 if alone else p[1] * p[2]))
                across, down = (1, 1) if alone else (max(p[1] for p in out["parts"]), max(p[2] for p in out["parts"]))
                out["across"], out["down"] = -(-out["width"] // (8 * across)), -(-out["height"] // (8 * down))
                out["scan"] = data[at + 2 + n :]
                return out
            at += 2 + n
    except (IndexError, KeyError, struct.error):
        return None


def _cut(scans: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scans without stuffing: bytes, where each restart segment begins, and the
    scan that each is from."""
    buf = np.frombuffer(b"".join(scans), np.uint8)
    mark = np.flatnonzero(buf[:-1] == 255)
    after = buf[mark + 1]
    keep = np.ones(len(buf), bool)
    keep[mark[after == 0] + 1] = False
    restart = mark[(after >= 0xD0) & (after <= 0xD7)]
    end = mark[after == 0xD9]
    for k in (restart, end):
        keep[k] = keep[k + 1] = False
    firsts = segments(np.array([len(s) for s in scans]))[:-1]
    begin = np.sort(np.concatenate((firsts, restart + 2)))
    place = np.concatenate(([0], np.cumsum(keep)))
    return buf[keep], place[begin], np.searchsorted(firsts, begin, "right") - 1


def coefficients(images: list[dict]) -> list[np.ndarray | None]:
    """Quantised coefficients of each image, (blocks in scan order, 64) in zigzag
    order, DC prediction undone. Images must share tables and MCU layout. None
    for a scan with an invalid code, a wrong count or missing data."""
    first = images[0]
    kinds = sorted({t for _, d, a in first["mcu"] for t in (d, a)})
    lut = np.stack([_table(*first["tables"][k]) for k in kinds]).reshape(-1)
    part = np.array([c for c, _, _ in first["mcu"]])
    dc = np.array([kinds.index(d) << 16 for _, d, _ in first["mcu"]])
    ac = np.array([kinds.index(a) << 16 for _, _, a in first["mcu"]])
    per = len(part)
    data, begin, owner = _cut([i["scan"] for i in images])
    ends = np.append(begin[1:], len(data))
    total = np.array([i["across"] * i["down"] for i in images])
    step = np.array([i["restart"] or i["across"] * i["down"] for i in images])
    number = np.arange(len(begin)) - np.searchsorted(owner, owner)  # of the segment in its image
    mcus = np.minimum(step[owner], total[owner] - number * step[owner])
    counted = np.bincount(owner, minlength=len(images))
    bad = counted != -(-total // step)
    mcus = np.where(bad[owner] | (mcus < 0), 0, mcus)
    blocks = mcus * per
    base = segments(blocks)
    out = np.zeros((int(base[-1]), 64), np.int16)
    cells = out.reshape(-1)
    # the 32 bits from each byte on
    held = np.concatenate((data, np.zeros(8, np.uint8)))
    window = held[:-4].astype(np.uint32) << 24 | held[1:-3].astype(np.uint32) << 16 | held[2:-2].astype(np.uint32) << 8 | held[3:-1]
    failed = np.zeros(len(begin), bool)
    bit, done, k = begin.astype(np.int64) * 8, np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
    prior = np.zeros((len(begin), int(part.max()) + 1), np.int64)
    live = np.flatnonzero(blocks > 0)
    limit = ends * 8
    b, d, z = bit[live], done[live], k[live]
    while len(live):
        slot = d % per
        peek = (window[b >> 3] << (b & 7).astype(np.uint32)) >> np.uint32(16)
        code = lut[np.where(z == 0, dc[slot], ac[slot]) + peek]
        size = code & 15
        run = np.where(z == 0, 0, (code >> 4) & 15)
        b = b + (code >> 8)
        raw = (window[np.minimum(b >> 3, len(window) - 1)] << (b & 7).astype(np.uint32)).astype(np.int64) & 0xFFFFFFFF
        raw >>= 32 - size
        value = np.where(raw < (1 << size >> 1), raw - (1 << size) + 1, raw)
        b = b + size
        is_dc = z == 0
        if is_dc.any():
            rows, comp = live[is_dc], part[slot[is_dc]]
            value[is_dc] += prior[rows, comp]
            prior[rows, comp] = value[is_dc]
        at = z + run
        over = (code == 0) | (b > limit[live]) | (at > 63)
        # a size of 0 is the end of the block, unless it skips sixteen zeros
        stop = (size == 0) & ~is_dc & (run != 15)
        write = ~over & ((size > 0) | is_dc)
        cells[(base[live[write]] + d[write]) * 64 + at[write]] = value[write]
        z = np.where(stop, 64, at + 1)
        full = z >= 64
        d = d + full
        z = np.where(full, 0, z)
        failed[live[over]] = True
        stay = (d < blocks[live]) & ~over
        if not stay.all():
            live, b, d, z = live[stay], b[stay], d[stay], z[stay]
    bad |= np.bincount(owner[failed], minlength=len(images)) > 0
    per_image = segments(np.bincount(owner, blocks, minlength=len(images)).astype(np.int64))
    return [None if bad[i] else out[per_image[i] : per_image[i + 1]] for i in range(len(images))]


def decode(media: list[bytes | None]) -> list[tuple[dict, np.ndarray] | None]:
    """(markers, coefficients) of each image; None for what can't be decoded."""
    out: list[tuple[dict, np.ndarray] | None] = [None] * len(media)
    alike: dict[tuple, list[int]] = defaultdict(list)
    found = [parse(m) if m else None for m in media]
    for i, p in enumerate(found):
        if p and all(t in p["tables"] for _, d, a in p["mcu"] for t in (d, a)) and p["scan"]:
            alike[(p["mcu"], tuple(sorted(p["tables"].items())))].append(i)
    for group in alike.values():
        for i, c in zip(group, coefficients([found[k] for k in group]), strict=True):
            out[i] = None if c is None else (found[i], c)
    return out


def thumbnail(image: dict, cells: np.ndarray) -> np.ndarray:
    """Luminance, one sample a block, from the DC coefficients alone."""
    part = image["parts"][0]
    luma = np.array([c == 0 for c, _, _ in image["mcu"]])
    dc = cells[:, 0].reshape(-1, len(luma))[:, luma].astype(np.int32) * int(image["quant"][part[3]][0])
    wide, high = (1, 1) if len(image["parts"]) == 1 else part[1:3]
    grid = dc.reshape(image["down"], image["across"], high, wide).transpose(0, 2, 1, 3).reshape(image["down"] * high, image["across"] * wide)
    grid = grid[: -(-image["height"] // 8), : -(-image["width"] // 8)]
    return np.clip((grid + 1024) / 8, 0, 255)


def feature(thumb: np.ndarray, side: int = 8) -> str:
    """Difference hash: is each cell of a ``side`` x (``side`` + 1) reduction
    brighter than the next. Lowercase hex."""

    def reduce(x: np.ndarray, n: int) -> np.ndarray:
        edge = np.linspace(0, len(x), n + 1)
        low = np.minimum(edge[:-1].astype(int), len(x) - 1)
        high = np.maximum(np.ceil(edge[1:]).astype(int), low + 1)
        upto = np.concatenate((np.zeros((1, *x.shape[1:])), np.cumsum(x, 0)))
        return (upto[high] - upto[low]) / (high - low)[:, None]

    small = reduce(reduce(thumb, side).T, side + 1).T
    return np.packbits(small[:, :-1] > small[:, 1:]).tobytes().hex()


def payload(image: dict, cells: np.ndarray) -> bytes | None:
    """The bytes that ``store`` was given; None if another program made the image."""
    told = image["comment"]
    if not told.startswith(b"payload="):
        return None
    return (cells.reshape(-1) & 255).astype(np.uint8).tobytes()[: int(told[8:])]


# -- columns -----------------------------------------------------------------


def store_column(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): every whole text, null as empty, as a JPEG."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_steps(batch, "text"):
                made = store([pad(t) for t in texts])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([len(t) for t in texts], pa.int64()), pa.array(made, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(make, "doc_id long, n_bytes long, media binary")


def media_features(media: DataFrame, step_bytes: int = 3 << 20) -> DataFrame:
    """Adds to (doc_id, n_bytes, media): width, height, feature, and digests of
    the stored bytes and of the payload read back from them.

    A null, cut or progressive image gives null in what can't be known. Equal
    media give equal values. Images are decoded in steps of ``step_bytes``.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, held in text_steps(batch, "media", step_bytes):
                rows = []
                for m, got in zip(held, decode(held), strict=True):
                    body = payload(*got) if got else None
                    rows.append((
                        got[0]["width"] if got else None,
                        got[0]["height"] if got else None,
                        None if body is None else len(body),
                        None if body is None else hashlib.sha256(body).hexdigest(),
                        None if body is None else zlib.crc32(body[-32:]),
                        len(m),
                        hashlib.sha256(m).hexdigest(),
                        f"{got[0]['width']}x{got[0]['height']}:{feature(thumbnail(*got))}" if got else None,
                    ))
                cols = list(zip(*rows, strict=True))
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                names = ["doc_id", "n_bytes", "width", "height", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names)

    return media.mapInArrow(read, "doc_id long, n_bytes long, width int, height int, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
