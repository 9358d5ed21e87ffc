"""JPEG: payloads come back, and images of other encoders decode to the same
coefficients as were put in."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from plumbline.llm import media, queries


def test_payloads_come_back():
    texts = ["", "a", "x" * 576, "ÿ" * 400, "\x00\xff" * 700, "b" * 40_000]
    payloads = [media.pad(t.encode()) for t in texts]
    assert [len(p) % 576 for p in payloads] == [0] * 6 and len(payloads[0]) == 576
    stored = media.store(payloads)
    for p, got in zip(payloads, media.decode(stored), strict=True):
        assert media.payload(*got) == p
        assert media.thumbnail(*got).shape == (got[0]["height"] // 8, got[0]["width"] // 8)


def test_what_is_no_image_is_none():
    whole = media.store([media.pad(b"abc")])[0]
    bad = [None, b"", b"text", whole[:40], whole[:-300], b"\xff\xd8\xff\xd9", whole.replace(b"\xff\xc0", b"\xff\xc2")]
    got = media.decode([*bad, whole])
    assert got[:-1] == [None] * len(bad) and got[-1] is not None


class Bits:
    """A plain encoder, one symbol after another."""

    def __init__(self) -> None:
        self.text = ""

    def put(self, value: int, n: int) -> None:
        self.text += format(value, f"0{n}b") if n else ""

    def number(self, v: int) -> tuple[int, int]:
        n = abs(v).bit_length()
        return n, v if v >= 0 else v + (1 << n) - 1

    def bytes(self) -> bytes:
        t = self.text + "1" * (-len(self.text) % 8)
        return bytes(int(t[i : i + 8], 2) for i in range(0, len(t), 8)).replace(b"\xff", b"\xff\x00")


def _codes(symbols: list[int]) -> tuple[bytes, dict[int, tuple[int, int]]]:
    """A canonical table with lengths from 2 up to 12."""
    counts, codes, code, i = [0] * 16, {}, 0, 0
    for length in range(1, 17):
        code <<= 1
        take = {1: 0, 2: 1, 3: 1, 4: 2}.get(length, 0) if length < 12 else min(len(symbols) - i, (1 << length) - 1 - code)
        for _ in range(min(take, len(symbols) - i)):
            codes[symbols[i]] = (code, length)
            code, i = code + 1, i + 1
            counts[length - 1] += 1
    return bytes(counts) + bytes(symbols), codes


def _jpeg(width, height, parts, blocks, restart=0):
    """``blocks``: coefficients in scan order, (n, 64) zigzag; one MCU's blocks at a time."""
    dc_raw, dc = _codes(list(range(12)))
    ac_raw, ac = _codes([r * 16 + s for r in range(16) for s in range(1, 11)] + [0, 0xF0])
    per = [c for c, (h, v) in enumerate(parts) for _ in range(h * v)] if len(parts) > 1 else [0]
    out, bits, prior = b"", Bits(), [0] * len(parts)
    mcus = len(blocks) // len(per)
    for m in range(mcus):
        if restart and m and m % restart == 0:
            out += bits.bytes() + bytes([255, 0xD0 + (m // restart - 1) % 8])
            bits, prior = Bits(), [0] * len(parts)
        for j, c in enumerate(per):
            row = blocks[m * len(per) + j]
            n, v = bits.number(int(row[0]) - prior[c])
            prior[c] = int(row[0])
            bits.put(*dc[n]), bits.put(v, n)
            zeros, last = 0, max([0, *np.flatnonzero(row)])
            for k in range(1, last + 1):
                if row[k] == 0:
                    zeros += 1
                    continue
                while zeros > 15:
                    bits.put(*ac[0xF0])
                    zeros -= 16
                n, v = bits.number(int(row[k]))
                bits.put(*ac[zeros * 16 + n]), bits.put(v, n)
                zeros = 0
            if last < 63:
                bits.put(*ac[0])
    seg = lambda k, b: bytes([255, k]) + (len(b) + 2).to_bytes(2, "big") + b
    frame = bytes([8]) + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([len(parts)]) + b"".join(bytes([c + 1, h * 16 + v, 0]) for c, (h, v) in enumerate(parts))
    scan = bytes([len(parts)]) + b"".join(bytes([c + 1, 0]) for c in range(len(parts))) + bytes([0, 63, 0])
    rst = seg(0xDD, restart.to_bytes(2, "big")) if restart else b""
    return b"\xff\xd8" + seg(0xDB, bytes([0]) + bytes([3]) * 64) + seg(0xC0, frame) + seg(0xC4, b"\x00" + dc_raw + b"\x10" + ac_raw) + rst + seg(0xDA, scan) + out + bits.bytes() + b"\xff\xd9"


@pytest.mark.parametrize("parts", [[(1, 1)], [(2, 2), (1, 1), (1, 1)], [(1, 1), (1, 1), (1, 1)]])
@pytest.mark.parametrize("restart", [0, 1, 4])
def test_other_encoders(parts, restart):
    rng = np.random.default_rng(7)
    made, want = [], []
    for width, height in ((8, 8), (33, 17), (100, 50)):
        h, v = (1, 1) if len(parts) == 1 else parts[0]
        mcus = -(-width // (8 * h)) * -(-height // (8 * v))
        n = mcus * (1 if len(parts) == 1 else sum(a * b for a, b in parts))
        blocks = np.where(rng.random((n, 64)) < 0.2, rng.integers(-900, 900, (n, 64)), 0)
        blocks[:, 0] = rng.integers(-500, 500, n)
        blocks[::5, 1:] = 0
        blocks[::7, 63] = 5
        made.append(_jpeg(width, height, parts, blocks, restart))
        want.append(blocks)
    for (image, cells), blocks in zip(media.decode(made), want, strict=True):
        assert np.array_equal(cells, blocks)
        thumb = media.thumbnail(image, cells)
        assert thumb.shape == (-(-image["height"] // 8), -(-image["width"] // 8))
        assert thumb[0, 0] == np.clip((blocks[0, 0] * 3 + 1024) / 8, 0, 255)
        assert len(media.feature(thumb)) == 16


def test_query(spark, sf):
    docs = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op7_media(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        p = media.pad(docs[r["doc_id"]])
        stored = media.store([p])[0]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(docs[r["doc_id"]]), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())


def test_nulls_copies_and_empty(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 2), (None, "x", 3), (3, "x", 4)], "doc_id long, text string, media int")
    got = media.media_features(media.store_column(df)).collect()
    by = {r["doc_id"]: tuple(r)[1:] for r in got}
    assert by[1] == by[2] and by[None] == by[3] and by[1][0] == 0
    assert media.media_features(media.store_column(df.limit(0))).count() == 0
    odd = spark.createDataFrame([(1, 0, None), (2, 3, bytearray(b"abc"))], "doc_id long, n_bytes long, media binary")
    assert [r["feature"] for r in media.media_features(odd).collect()] == [None, None]


def _plain_media(text):
    """The stored bytes and the feature's cells of a text, bit by bit in plain Python."""
    data = text + b"\xff" * (576 if not text else -len(text) % 576)
    blocks = len(data) // 64
    across = 9 * max(1, -(-blocks // (9 * 8191)))
    down = -(-blocks // across)
    whole = data + b"\xff" * (across * down * 64 - len(data))
    scan = bytearray()
    for n in range(across * down):
        # each coefficient is byte + 256: the one code (0), then nine bits
        bits = "".join(f"0{b + 256:09b}" for b in whole[n * 64 : n * 64 + 64])
        for k in range(0, len(bits), 8):
            byte = int(bits[k : k + 8], 2)
            scan += bytes([byte, 0]) if byte == 255 else bytes([byte])
        scan += bytes([0xFF, 0xD9 if n == across * down - 1 else 0xD0 + n % 8])
    marker = lambda kind, body: bytes([0xFF, kind]) + (len(body) + 2).to_bytes(2, "big") + body
    head = b"\xff\xd8" + marker(0xFE, b"payload=%d" % len(data)) + marker(0xDB, bytes([0] + [1] * 64))
    head += marker(0xC0, bytes([8]) + (down * 8).to_bytes(2, "big") + (across * 8).to_bytes(2, "big") + bytes([1, 1, 0x11, 0]))
    for kind in (0x00, 0x10):
        head += marker(0xC4, bytes([kind, 1] + [0] * 15 + [9]))
    head += marker(0xDD, b"\x00\x01") + marker(0xDA, bytes([1, 1, 0, 0, 63, 0]))
    light = [[Fraction(whole[(y * across + x) * 64] + 256 + 1024, 8) for x in range(across)] for y in range(down)]

    def span(i, parts, n):
        low = min(i * n // parts, n - 1)
        return range(low, max(-(-(i + 1) * n // parts), low + 1))

    mean = lambda values: sum(values) / len(values)
    cells = [[mean([mean([light[y][x] for y in span(r, 8, down)]) for x in span(c, 9, across)]) for c in range(9)] for r in range(8)]
    return head + bytes(scan), (across * 8, down * 8), cells


def test_against_plain_python(spark):
    rng = random.Random(9)
    texts = ["", "a", "x" * 576, "".join(chr(rng.randrange(32, 0x250)) for _ in range(3000)), "ÿ" * 700, "line\n" * 2000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in media.media_features(media.store_column(df)).collect():
        stored, (width, height), cells = _plain_media(texts[r["doc_id"]].encode())
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())
        size, bits = r["feature"].split(":")
        assert size == f"{width}x{height}" == f"{r['width']}x{r['height']}"
        got = f"{int(bits, 16):064b}"
        for k, (left, right) in enumerate((row[c], row[c + 1]) for row in cells for c in range(8)):
            if left != right:  # of equal cells, rounding may say either
                assert got[k] == str(int(left > right)), (r["doc_id"], k)
