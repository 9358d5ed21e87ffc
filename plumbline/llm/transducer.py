"""Minimal acyclic transducers from sorted terms to their ordinals.

States with the same continuations are one state, found while the terms go by in
order. A transition's output is the number of terms that end before its own, so the
outputs along a term's path sum to its place in lexicographic order of bytes, and
the path of an ordinal can be found again from the ordinal alone.
"""

from __future__ import annotations

import io
from collections.abc import Iterable

import numpy as np


class Transducer:
    def __init__(self, keys: np.ndarray, to: np.ndarray, add: np.ndarray, final: np.ndarray):
        #: Transitions in order of (state, byte), as state * 256 + byte.
        self.keys = keys
        self.to = to
        self.add = add
        self.final = final

    @classmethod
    def build(cls, terms: Iterable[bytes]) -> Transducer:
        """From distinct terms in order of their bytes."""
        known: dict[tuple, int] = {}
        below: list[int] = []  # terms that can be read from each state
        # the states of the last term's path, each [final, bytes, targets]
        path: list[list] = [[False, [], []]]

        def settle(depth: int) -> None:
            """States of the path beyond ``depth`` get no further continuation."""
            while len(path) > depth + 1:
                final, labels, targets = path.pop()
                path[-1][2].append(state(final, labels, targets))

        def state(final: bool, labels: list[int], targets: list[int]) -> int:
            key = (final, bytes(labels), tuple(targets))
            if (found := known.get(key)) is None:
                found = known[key] = len(below)
                below.append(final + sum(below[t] for t in targets))
            return found

        last = b""
        for term in terms:
            if term <= last and (last or path[0][0]):
                raise ValueError("terms must be distinct and sorted")
            same = 0
            for a, b in zip(last, term, strict=False):
                if a != b:
                    break
                same += 1
            settle(same)
            for byte in term[same:]:
                path[-1][1].append(byte)
                path.append([False, [], []])
            path[-1][0] = True
            last = term
        settle(0)
        state(*path[0])  # the last state is the start
        keys, to, add = [], [], []
        for s, (final, labels, targets) in enumerate(known):
            before = int(final)
            for byte, t in zip(labels, targets, strict=True):
                keys.append(s << 8 | byte)
                to.append(t)
                add.append(before)
                before += below[t]
        return cls(np.array(keys, np.int64), np.array(to, np.int64), np.array(add, np.int64), np.array([k[0] for k in known], bool))

    def ordinals(self, terms: list[bytes]) -> np.ndarray:
        """Each term's ordinal, or -1; all terms take their steps together."""
        out = np.full(len(terms), -1, np.int64)
        if not len(terms):
            return out
        size = np.array([len(t) for t in terms], np.int64)
        buf = np.frombuffer(b"".join(terms), np.uint8).astype(np.int64)
        at = np.cumsum(size) - size
        who = np.arange(len(terms))
        state = np.full(len(terms), len(self.final) - 1, np.int64)
        total = np.zeros(len(terms), np.int64)
        step = 0
        while len(who):
            ends = size[who] == step
            done = ends & self.final[state]
            out[who[done]] = total[done]
            who, state, total = who[~ends], state[~ends], total[~ends]
            if not len(who) or not len(self.keys):
                break
            key = state << 8 | buf[at[who] + step]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[found] == key
            who, found = who[ok], found[ok]
            state, total = self.to[found], total[ok] + self.add[found]
            step += 1
        return out

    def term(self, ordinal: int) -> bytes:
        """The term of an ordinal."""
        state, left, out = len(self.final) - 1, int(ordinal), bytearray()
        while left or not self.final[state]:
            a, b = np.searchsorted(self.keys, [state << 8, (state + 1) << 8])
            t = a + int(np.searchsorted(self.add[a:b], left, side="right")) - 1
            if t < a:
                raise IndexError(ordinal)
            out.append(int(self.keys[t]) & 255)
            left -= int(self.add[t])
            state = int(self.to[t])
        return bytes(out)

    def dump(self) -> bytes:
        held = io.BytesIO()
        np.savez(held, keys=self.keys, to=self.to, add=self.add, final=self.final)
        return held.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Transducer:
        held = np.load(io.BytesIO(data), allow_pickle=False)
        return cls(held["keys"], held["to"], held["add"], held["final"])

    @property
    def n_bytes(self) -> int:
        return self.keys.nbytes + self.to.nbytes + self.add.nbytes + self.final.nbytes
