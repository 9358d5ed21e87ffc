"""Token ids of whole texts by a public tokenizer file.

A byte-pair tokenizer encodes each pre-token on its own, and no pre-token
crosses a place where one space or line end stands between two other
characters. So a text is cut there, and each distinct piece is given to the
tokenizers library once per worker; its ids are then looked up, all pieces of a
batch at once. A piece is found by hash and taken only if it is the same bytes.
A text with other white space (runs, tabs, spaces at the end) goes to the library
whole where that matters, and so does one with a piece of over ``PIECE_BYTES``, which
isn't kept, or with a special token's string, which is that token, as the library has it. Very long texts are cut at such places first,
so that a step's memory has a bound. ``tests/llm`` compares the ids with the
library's own for whole texts.
"""

from __future__ import annotations

import os
import re

import numpy as np

from .words import equal_runs, hash_runs, join, segments, spread

#: Pieces kept per worker, and their bytes; beyond either the table starts anew.
KEPT_PIECES, KEPT_BYTES = 800_000, 24 << 20
#: A text with a longer piece (of a script without spaces) goes to the library whole.
PIECE_BYTES = 1024
#: A longer text is encoded in parts of about this size.
PART_BYTES = 4 << 20
_ODD = re.compile(r"\s\s|[^\S \n]|᠎|\s\Z")
#: One space or line end between characters that are no white space, in UTF-8.
_BETWEEN = re.compile(rb"(?<=[!-~\x80-\xbf])(?<!\xc2[\x85\xa0])(?<![\xe1-\xe3][\x80\x81\x9a\xa0].)[ \n](?=[!-~\xc3-\xe0\xe4-\xf4])", re.S)
_SPACE = np.uint64(0x9E3779B97F4A7C15)
_open: dict[str, "Ids"] = {}


def opened(path: str) -> "Ids":
    """The tokenizer of this file; a worker keeps it from task to task."""
    if path not in _open:
        _open[path] = Ids(path)
    return _open[path]


_GAP = np.zeros(256, bool)
_GAP[[32, 10]] = True
#: Bytes that are white space other than those, or begin such a character with a byte of _THEN.
_OTHER, _BEGINS, _THEN = (np.isin(np.arange(256), x) for x in ([9, 11, 12, 13, 28, 29, 30, 31], [0xC2, 0xE1, 0xE2, 0xE3], [0x80, 0x81, 0x85, 0x9A, 0xA0]))


def _perhaps_odd(buf: np.ndarray, at: np.ndarray) -> list[int]:
    """The joined texts that may hold white space other than single spaces and
    line ends between characters: all that do, and few others."""
    gap = _GAP[buf]
    odd = _OTHER[buf]
    # the space after a text shows white space that ends it
    odd[:-1] |= gap[:-1] & gap[1:] | _BEGINS[buf[:-1]] & _THEN[buf[1:]]
    return np.unique(np.searchsorted(at, np.flatnonzero(odd), "right") - 1).tolist()


class Ids:
    """Ids of texts for one tokenizer file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        #: Whether a space before a word belongs to it. Otherwise the file drops white space.
        self.spaces = "</w>" != self.library.model.end_of_word_suffix
        added = [t.content for _, t in sorted(self.library.get_added_tokens_decoder().items())]
        self.special, self.mark = [t.encode() for t in added], added[-1]
        self.mark_id = self.library.token_to_id(self.mark)
        self.vocabulary = self.library.get_vocab_size()
        self._clear()

    def _clear(self) -> None:
        self.keys, self.flat, self.raw = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint8)
        #: Of each key: where its ids and its bytes are, and whether a space leads.
        self.where, self.size, self.at, self.length = (np.zeros(0, np.int32) for _ in range(4))
        self.lead = np.zeros(0, bool)

    def whole(self, text: str) -> np.ndarray:
        """Ids of one text, by the library alone."""
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, keys: np.ndarray, leads: np.ndarray, pieces: list[bytes]) -> None:
        said = [b" " + p if x else p for x, p in zip(leads.tolist(), pieces, strict=True)]
        ids, where, size, used = [self.flat], [], [], len(self.flat)
        for a in range(0, len(said), 512):
            text = self.mark.encode().join(said[a : a + 512]).decode()
            out = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            # a piece's ids are those between two marks
            edge = np.concatenate(([-1], np.flatnonzero(out == self.mark_id), [len(out)]))
            ids.append(out)
            where.append(edge[:-1] + 1 + used)
            size.append(np.diff(edge) - 1)
            used += len(out)
        where, size = np.concatenate(where), np.concatenate(size)
        length = np.array([len(x) for x in pieces], np.int64)
        at = len(self.raw) + segments(length)[:-1]
        self.flat = np.concatenate(ids)
        self.raw = np.concatenate((self.raw, np.frombuffer(b"".join(pieces), np.uint8)))
        put = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, put, keys)
        for name, new in (("where", where), ("size", size), ("at", at), ("length", length), ("lead", leads)):
            held = getattr(self, name)
            setattr(self, name, np.insert(held, put, new.astype(held.dtype)))

    def _found(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after another, and where each text's
        begin (with the end)."""
        if max(map(len, texts), default=0) <= PART_BYTES:
            return self._encode(texts)
        ids = [np.concatenate([self._encode([p])[0] for p in cut(t)]) for t in texts]
        return np.concatenate(ids), segments(np.array([len(x) for x in ids]))

    def _encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        buf, at = join(texts)
        whole = {i for i, t in enumerate(texts) if any(x in t for x in self.special)}
        if self.spaces:
            whole |= {i for i in _perhaps_odd(buf, at) if _ODD.search(texts[i].decode())}
        slow = {i: self.whole(texts[i].decode()) for i in whole}
        if slow:
            buf, at = join([b"" if i in slow else t for i, t in enumerate(texts)])
        # places without a gap for too long
        gap = np.flatnonzero(_GAP[buf])
        far = np.flatnonzero(np.diff(gap, prepend=-1) > PIECE_BYTES)
        if len(far):
            more = set(np.unique(np.searchsorted(at, gap[far] - 1, "right") - 1).tolist()) - slow.keys()
            slow |= {i: self.whole(texts[i].decode()) for i in more}
            buf, at = join([b"" if i in slow else t for i, t in enumerate(texts)])
        space, line = buf == 32, buf == 10
        body = ~(space | line)
        first = body.copy()
        first[1:] &= ~body[:-1]
        # a text's own first byte begins a piece, whatever stands before it
        starts_text = np.zeros(len(buf) + 1, bool)
        starts_text[at] = True
        first |= body & starts_text[:-1]
        last = body.copy()
        last[:-1] &= ~body[1:]
        if self.spaces:
            first |= line
            last |= line
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        keys = hash_runs(buf, starts, ends)
        lead = np.zeros(len(starts), bool)
        if self.spaces:
            lead = (starts > 0) & space[starts - 1] & ~starts_text[starts]
            keys[lead] ^= _SPACE
        each, where, back = np.unique(keys, return_index=True, return_inverse=True)
        new = np.flatnonzero(~self._found(each))
        if len(new) and (len(self.keys) + len(new) > KEPT_PIECES or len(self.raw) + int((ends - starts)[where[new]].sum()) > KEPT_BYTES):
            self._clear()
            new = np.arange(len(each))
        if len(new):
            raw = buf.tobytes()
            self._learn(each[new], lead[where[new]], [raw[starts[i] : ends[i]] for i in where[new]])
        place = np.searchsorted(self.keys, each)[back]
        of = np.searchsorted(starts, at)
        # up to eight bytes a hash of one length has one word only
        length = ends - starts
        other = (self.length[place] != length) | (self.lead[place] != lead)
        far = np.flatnonzero((length > 8) & ~other)
        other[far] = ~equal_runs(buf, starts[far], self.raw, self.at[place[far]].astype(np.int64), length[far])
        for i in np.unique(np.searchsorted(of, np.flatnonzero(other), "right") - 1).tolist():
            slow[i] = self.whole(texts[i].decode())
        size = self.size[place].astype(np.int64)
        ids = self.flat[spread(self.where[place].astype(np.int64), size)]
        of = segments(size)[of]
        if not slow:
            return ids, of
        parts = [slow[i] if i in slow else ids[of[i] : of[i + 1]] for i in range(len(texts))]
        return np.concatenate(parts), segments(np.array([len(p) for p in parts]))


def cut(text: bytes, size: int = PART_BYTES) -> list[bytes]:
    """A text in parts of about ``size`` bytes that are encoded alike on their own:
    each but the first begins with a space or line end between two other characters."""
    out, a = [], 0
    while len(text) - a > size and (m := _BETWEEN.search(text, a + size)):
        out.append(text[a : m.start()])
        a = m.start()
    return [*out, text[a:]]
