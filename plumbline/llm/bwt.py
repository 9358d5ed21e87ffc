"""Repeated strings of a minimum length in a buffer, from its Burrows-Wheeler transform.

Common prefixes of neighbouring suffixes are found by increasing value: the intervals
of all strings of one length are extended backwards by a byte, all at once, and an
interval whose right end is new says that the suffixes there share exactly that
length and is the only kind that goes on. The search stops at the minimum length; the
suffixes that it hasn't set apart by then begin alike.
"""

from __future__ import annotations

import numpy as np

from .words import spread

#: A byte that UTF-8 doesn't have, between strings.
GAP_BYTE = 0xFF


def sorted_rotations(buf: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the buffer's rotations in order of their first ``depth`` bytes at
    least, by doubling; only rotations that are still alike are sorted again."""
    n = len(buf)
    held = np.concatenate((np.tile(buf, 8 // n + 1) if n < 8 else buf, buf[:8]))
    eight = np.lib.stride_tricks.as_strided(held[:8].view(">u8"), (n,), (1,)).astype(np.uint64)
    sa = np.argsort(eight, kind="stable")
    new = np.append(True, np.diff(eight[sa]) != 0)
    # a rotation's rank is the first row of those that are like it
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    width = 8
    rows = np.arange(n)
    while width < depth:
        first = np.append(new[rows], True)
        alone = first[:-1] & first[1:]  # rows of a group follow each other
        rows = rows[~alone]
        if not len(rows):
            break
        at = sa[rows]
        key = rank[at] * n + rank[(at + width) % n]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        sa[rows] = at
        new[rows] = np.append(True, np.diff(key) != 0)
        rank[at] = np.maximum.accumulate(np.where(new[rows], rows, 0))
        width *= 2
    return sa


def set_apart(bwt: np.ndarray, least: int) -> np.ndarray:
    """For each row, whether its rotation differs from the one before within
    ``least`` bytes."""
    n = len(bwt)
    back = np.empty(n, np.int64)
    back[np.argsort(bwt, kind="stable")] = np.arange(n)
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    lo, hi = np.array([0]), np.array([n])
    for _ in range(least):
        # runs of one byte in the intervals, and then one part for each byte
        size = hi - lo
        rows = spread(lo, size)
        key = np.repeat(np.arange(len(lo)) << 8, size) | bwt[rows]
        run = np.flatnonzero(np.diff(key, prepend=-1))
        length, key, row = np.diff(np.append(run, len(rows))), key[run], rows[run]
        order = np.argsort(key, kind="stable")
        key = key[order]
        part = np.flatnonzero(np.diff(key, prepend=-1))
        lo = back[row[order[part]]]
        hi = lo + np.add.reduceat(length[order], part)
        go = ~known[hi]
        lo, hi = lo[go], hi[go]
        if not len(lo):
            break
        known[hi] = True
    return known[:n]


def classes(strings: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, class) of each place in the strings at which ``least`` bytes
    begin; places of one class, and no others, begin with the same ``least`` bytes."""
    gap = bytes([GAP_BYTE])
    buf = np.frombuffer(gap.join([*strings, b""]), np.uint8)
    size = np.array([len(s) for s in strings], np.int64)
    begin = np.cumsum(size + 1) - size - 1
    of = np.repeat(np.arange(len(strings)), np.maximum(size - least + 1, 0))
    at = spread(begin, np.maximum(size - least + 1, 0))
    if not len(at):
        return of, at, at
    sa = sorted_rotations(buf, least)
    name = np.empty(len(buf), np.int64)
    name[sa] = np.cumsum(set_apart(buf[sa - 1], least))
    return of, at - begin[of], name[at]
