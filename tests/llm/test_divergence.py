from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import divergence, queries
from plumbline.llm.transducer import Transducer

_TERMS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def _terms(text):
    return _TERMS.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def _brute(rows, min_docs=3, top=200):
    docs = [(lang or "", source or "", _terms(text)) for lang, source, text in rows]
    out = []
    for lang in sorted({d[0] for d in docs}):
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = sorted((t for t, n in df.items() if n >= min_docs), key=str.encode)
        share = lambda c, kept=kept: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}
        count = {s: Counter(t for d in mine if d[1] == s for t in d[2]) for s in {d[1] for d in mine}}
        p = {s: share(c) for s, c in count.items()}
        q = share(sum(count.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s in count:
            parts = {"pair": [(h, sum(f(p[s][t], p[h][t]) for t in kept)) for h in count if h != s]}
            parts["term"] = [(t, f(p[s][t], q[t])) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


def _run(spark, rows, **more):
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    return sorted(tuple(r) for r in divergence.audit(df, **more).select("lang", "source", "part", "item", "value", "rank").collect())


_WORDS = st.lists(st.binary(min_size=0, max_size=6) | st.sampled_from([b"a", b"ab", b"abc", b"b", b"bc", b"\xff\xfe", b"station", b"nation"]), max_size=60)


@settings(max_examples=60, deadline=None)
@given(_WORDS)
def test_transducer_numbers_terms_in_order(words):
    held = sorted(set(words))
    t = Transducer.load(Transducer.build(held).dump())
    assert t.ordinals(held).tolist() == list(range(len(held)))
    assert [t.term(i) for i in range(len(held))] == held
    out = [w + b"x" for w in held if w + b"x" not in set(held)] + [w[:-1] for w in held if w[:-1] not in set(held)]
    assert (t.ordinals(out) == -1).all()


def test_transducer_is_minimal():
    # 26 ** 3 words of one shape need a state a letter, not one a word
    words = sorted(bytes([a, b, c]) for a in range(97, 123) for b in range(97, 123) for c in range(97, 123))
    assert len(Transducer.build(words).final) == 4
    t = Transducer.build(sorted([b"nations", b"stations", b"nation", b"station"]))
    # the two stems share all that follows them
    assert len(t.final) == 9
    with pytest.raises(ValueError):
        Transducer.build([b"b", b"a"])


def test_terms_of_a_long_text(monkeypatch):
    monkeypatch.setattr(divergence, "_PART", 5)
    text = "Ab, cd-EF \x00gh É ünder_score 1x2 " * 20
    assert [t.decode() for part in divergence.terms(text.encode()) for t in part] == _terms(text)


def test_small_tables(spark):
    rows = [
        ("en", "a", "Red red blue"), ("en", "a", "red green"), ("en", "b", "red, blue"), ("en", "b", "blue GREEN green"), ("en", "c", None), ("en", "c", "green"),
        ("en", None, "red blue"), (None, None, "x"), (None, "z", "x y"), (None, "z", "x y y"), ("fr", "a", ""), ("fr", "b", "unique"), ("en", "a", "red green"),
        ("ja", "a", "日本 語"), ("ja", "b", "日本"), ("ja", "b", "日本 É"), ("ja", "b", "É É"), ("ja", "a", "É"),
    ]
    assert _run(spark, rows) == _brute(rows)
    assert _run(spark, rows, min_docs=1, top=1) == _brute(rows, 1, 1)
    assert _run(spark, []) == []


def test_more_sources_than_a_block_and_shards_of_few_terms(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    rows = [("en", f"s{s}", " ".join(rng.choice(words[: 20 + s % 40], rng.integers(1, 30)))) for s in range(150) for _ in range(2)]
    assert _run(spark, rows, shard_terms=7) == _brute(rows)


def test_squares_are_exact():
    rng = np.random.default_rng(8)
    for lo, hi in ((0, 0), (0, 1)):
        square = divergence._Square(("x", lo, hi))
        n = 7
        at = np.concatenate((np.arange(n), np.arange(n) + divergence.BLOCK)) if hi else np.arange(n)
        count = rng.integers(0, 5, (len(at), 40)) * (rng.random((len(at), 40)) < 0.4)
        share = 1 + 10**9 * (count + 1) // (count.sum(1, keepdims=True) + 40)
        square.source(at, 1 + 10**9 // (count.sum(1) + 40))
        square.v = 40
        t, s = np.nonzero(count.T)
        for part in np.array_split(np.arange(40), 3):
            go = np.isin(t, part)
            square.add(t[go], at[s[go]], share[s[go], t[go]])
        got = {(r["g"], r["h"]): r["value"] for r in square.rows().to_pylist()}
        want = {(int(g), int(h)): int(divergence.divergence(share[i], share[j]).sum()) for i, g in enumerate(at) for j, h in enumerate(at) if i != j and (not hi or (i < n) != (j < n))}
        assert got == want


def test_query(spark, sf, duck, same):
    assert same(queries.op12_divergence(spark, sf), duck, queries.ORACLE["op12_divergence"]) > 100
