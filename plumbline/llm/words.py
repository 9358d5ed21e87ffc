"""Words of many texts at once, in numpy: boundaries and 64-bit hashes.

A word's hash mixes its length and then eight bytes at a time, each step a
bijection: words of one length and at most eight bytes never share one, others
with a chance of about 2**-64 a pair, whatever their structure. Words beyond
``LONG`` bytes are hashed by a cryptographic hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

LONG = 256
_MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hash_runs(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``buf[start:end]`` for each pair."""
    left = ends - starts
    h = mix(left.astype(np.uint64))
    held = np.concatenate((buf, np.zeros(8, np.uint8)))
    # the eight bytes from each place on, as one number
    eight = np.lib.stride_tricks.as_strided(held[:8].view("<u8"), (len(buf) + 1,), (1,))
    for i in np.flatnonzero(left > LONG).tolist():
        raw = hashlib.blake2b(buf[starts[i] : ends[i]], digest_size=8).digest()
        h[i] = np.frombuffer(raw, "<u8")[0]
    who = np.flatnonzero((left > 0) & (left <= LONG))
    at, left = starts[who], left[who]
    while len(who):
        h[who] = mix(h[who] ^ eight[at] & _MASK[np.minimum(left, 8)])
        go = left > 8
        who, at, left = who[go], at[go] + 8, left[go] - 8
    return h


def equal_runs(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether ``a[a_at : a_at + length]`` and the same of ``b`` are the same
    bytes, for each; eight at a time."""
    same = np.ones(len(lengths), bool)
    first, second = (np.lib.stride_tricks.as_strided(np.concatenate((x, np.zeros(8, np.uint8)))[:8].view("<u8"), (len(x) + 1,), (1,)) for x in (a, b))
    who = np.flatnonzero(lengths > 0)
    p, q, left = a_at[who], b_at[who], lengths[who]
    while len(who):
        differ = ((first[p] ^ second[q]) & _MASK[np.minimum(left, 8)]) != 0
        same[who[differ]] = False
        go = (left > 8) & ~differ
        who, p, q, left = who[go], p[go] + 8, q[go] + 8, left[go] - 8
    return same


def parts(text: bytes, size: int) -> Iterator[bytes]:
    """A text in slices of about ``size`` bytes, cut after white space only."""
    a = 0
    while len(text) - a > size:
        cut = max(text.rfind(c, a, a + size) for c in _GAPS)
        if cut < 0:  # one word: up to its end
            cut = min((k for c in _GAPS if (k := text.find(c, a + size)) >= 0), default=len(text))
        yield text[a : cut + 1]
        a = cut + 1
    yield text[a:]


def join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one buffer, a space after each, and where each begins (with
    one more for the end)."""
    buf = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    return buf, at


def words(buf: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not in ``gap``."""
    edge = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


#: Space and the control characters 9 to 13.
GAP = np.zeros(256, bool)
GAP[[32, 9, 10, 11, 12, 13]] = True
_GAPS = [bytes([c]) for c in np.flatnonzero(GAP).tolist()]
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def segments(counts: np.ndarray) -> np.ndarray:
    """Offsets of consecutive groups of these sizes, with the total at the end."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def spread(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of ``[offset, offset + length)`` for all pairs, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = segments(lengths)[:-1]
    return np.arange(total, dtype=np.int64) + np.repeat(offsets - at, lengths)
