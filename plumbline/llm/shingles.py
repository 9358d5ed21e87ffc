"""Sets of word shingles of whole texts, as sorted 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

from .words import GAP, LOWER, hash_runs, join, mix, parts, segments, words

_TURN = np.random.Generator(np.random.PCG64(91)).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


#: A longer text is hashed in parts of this size.
PART_BYTES = 8 << 20


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, one text after another, and where each text's begin."""
    if len(texts) == 1 and len(texts[0]) > PART_BYTES:
        h = np.concatenate([_hash_joined([p])[0] for p in parts(texts[0], PART_BYTES)])
        return h, np.array([0, len(h)])
    return _hash_joined(texts)


def _hash_joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    buf, at = join(texts)
    buf = LOWER[buf]
    starts, ends = words(buf, GAP[buf])
    return hash_runs(buf, starts, ends), np.searchsorted(starts, at)


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``k`` words of each text (A-Z lowered, words are runs
    without white space), sorted, one text after another, and where each text's
    begin (with the end). Fewer words: the whole sequence is one shingle; no
    word: none."""
    h, of = _word_hashes(texts)
    n = np.diff(of)
    doc = np.repeat(np.arange(len(texts)), n)
    place = np.arange(len(h)) - of[doc]
    total = np.zeros(len(h), np.uint64)
    for j in range(k):
        shifted = np.zeros(len(h), np.uint64)
        shifted[: max(len(h) - j, 0)] = h[j:]
        inside = place + j < n[doc]
        total += np.where(inside, shifted * _TURN[j], np.uint64(0))
    total = mix(total + np.minimum(n, k).astype(np.uint64)[doc])
    first = (place + k <= n[doc]) | (place == 0)
    value, doc = total[first], doc[first]
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    sets = [np.unique(value[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return (np.concatenate(sets) if sets else value), segments(np.array([len(s) for s in sets], np.int64))
