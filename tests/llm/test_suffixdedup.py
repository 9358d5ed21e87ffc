from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import bwt, queries, suffixdedup


def _brute(rows, least):
    """Rows in order of id (null first); of one id in order of the hash that the
    operator uses, which these tests avoid needing by using each id once or with one text."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen: dict = {}
    out = []
    for i in order:
        b = (rows[i][1] or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - least + 1):
            if b[s : s + least] in seen:
                gone[s : s + least] = b"\x01" * least
            else:
                seen[b[s : s + least]] = True
        spans = sum(1 for x in range(len(b)) if gone[x] and (x == 0 or not gone[x - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((rows[i][0], len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _run(spark, rows, least, **more):
    df = spark.createDataFrame([(*r, 1, "y") for r in rows], "doc_id long, text string, d int, row string")
    got = suffixdedup.remove_repeats(df, least, **more)
    rows = got.collect()
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in rows)
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(97 + x % 3 for x in b)), max_size=8), st.integers(1, 20))
def test_classes_are_those_of_equal_strings(strings, least):
    of, at, name = bwt.classes(strings, least)
    want = [(i, p) for i, s in enumerate(strings) for p in range(len(s) - least + 1)]
    assert list(zip(of.tolist(), at.tolist(), strict=True)) == want
    by: dict = {}
    for (i, p), c in zip(want, name.tolist(), strict=True):
        by.setdefault(strings[i][p : p + least], set()).add(c)
    assert all(len(c) == 1 for c in by.values()) and len(set().union(*by.values())) == len(by)


def test_anchors_cover_each_string_once():
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"abcd") for _ in range(n)) for n in (0, 99, 100, 101, 1000)] + [b"a" * 500, b"ab" * 300]
    text, s, n, x, _ = suffixdedup.anchored(texts, 100)
    got = sorted((t, a + i) for t, a, m in zip(text.tolist(), s.tolist(), n.tolist(), strict=True) for i in range(m))
    assert got == [(t, i) for t, b in enumerate(texts) for i in range(len(b) - 99)]
    # the anchor of a string is the same wherever it stands
    piece = texts[4][300:420]
    other = [b"x" * 77 + piece + b"y" * 50]
    a = {i: k for a, m, k in zip(*suffixdedup.anchored([texts[4]], 100)[1:4], strict=True) for i in range(a, a + m)}
    b = {i: k for a, m, k in zip(*suffixdedup.anchored(other, 100)[1:4], strict=True) for i in range(a, a + m)}
    assert all(a[300 + i] == b[77 + i] for i in range(21))


def _family(seed, n=40):
    """Texts with copies, edited copies, shared passages and repeats in themselves."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(1, 9)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(30) for _ in range(3)]
    texts = [prose(rng.randrange(0, 80)) for _ in range(n // 2)]
    for _ in range(n - len(texts)):
        t = rng.choice(texts)
        kind = rng.randrange(5)
        if kind == 1 and t:
            p = rng.randrange(len(t))
            t = t[:p] + "#" + t[p + rng.randrange(3) :]
        elif kind == 2:
            t = prose(10) + rng.choice(passages) + prose(10)
        elif kind == 3:
            t = t[len(t) // 3 :] + t + "z" * rng.randrange(300)
        elif kind == 4:
            t = ("ab" * 200)[: rng.randrange(400)] + rng.choice(passages)[5:]
        texts.append(t)
    ids = rng.sample(range(1000), len(texts))
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("least,contexts,batch", [(100, 256, 1 << 20), (40, 256, 1), (60, 2, 500), (60, 0, 500)])
def test_families(spark, least, contexts, batch):
    rows = _family(least + contexts)
    want = _brute(rows, least)
    assert sum(r[2] > 0 for r in want) > 5
    assert _run(spark, rows, least, most_contexts=contexts, batch_bytes=batch) == want


def test_strings_of_hot_anchors_go_as_runs(spark, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh ") for _ in range(500))
    rows = [(i, text[:p] + f"#{i:04}" + text[p + 5 :]) for i, p in enumerate(rng.choices(range(495), k=500))]
    kept, real = [], suffixdedup.materialise
    monkeypatch.setattr(suffixdedup, "materialise", lambda df, tag: kept.append(real(df, tag)) or kept[-1])
    assert _run(spark, rows, 100, most_contexts=20) == _brute(rows, 100)
    told = [r["n"] for r in kept[-1].collect()]
    assert 4 * len(told) < sum(told)


def test_edges(spark):
    long = "0123456789" * 10 + "tail" * 30
    rows = [(3, long), (3, long), (1, None), (2, ""), (4, "x" * 99), (5, "x" * 100), (6, "x" * 350), (7, "é" * 50), (8, "é" * 50 + "!"), (None, long[:150])]
    assert _run(spark, rows, 100) == _brute(rows, 100)
    assert _run(spark, [], 100) == []
    with pytest.raises(ValueError):
        suffixdedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string"), 32)


def test_texts_of_several_pieces(spark):
    rng = np.random.default_rng(6)
    a = rng.integers(97, 123, 5_000_000, dtype=np.uint8).tobytes().decode()
    cut = 2 * suffixdedup.STEP_BYTES + 50  # inside the overlap of two pieces
    rows = [(1, a), (2, "new " + a[cut - 400 : cut + 400] + " text"), (3, a[1234:]), (4, "ab" * 1_500_000)]
    got = {r[0]: r[1:4] for r in _run(spark, rows, 100)}
    assert got == {1: (5_000_000, 0, 0), 2: (809, 800, 1), 3: (5_000_000 - 1234, 5_000_000 - 1234, 1), 4: (3_000_000, 3_000_000 - 2, 1)}


def test_query(spark, sf, duck, same):
    assert same(queries.op11_suffixdedup(spark, sf).drop("kept"), duck, queries.ORACLE["op11_suffixdedup"]) == 200
