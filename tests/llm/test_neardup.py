from __future__ import annotations

import random
import re

import numpy as np
import pytest

from plumbline.llm import neardup, queries
from plumbline.llm.shingles import shingle_sets


def _set(text, k):
    t = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def _brute(rows, k, percent):
    """Component of each (doc_id, text) row: all pairs, then least ids."""
    sets = [_set(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def _compare(spark, rows, k, percent):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_duplicates(df, neardup.Settings(words=k, percent=percent)).collect()
    want = sorted(((d, *b) for (d, _), b in zip(rows, _brute(rows, k, percent), strict=True)), key=repr)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["component_id"] is not None)


def _family(n, words, edits, seed):
    rng = random.Random(seed)
    first = [f"w{rng.randrange(500)}" for _ in range(words)]
    for _ in range(n):
        copy = list(first)
        for _ in range(rng.randrange(edits)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        yield " ".join(copy)


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_all_pairs_of_families(spark, k, percent):
    texts = [t for s in range(6) for t in _family(25, 120, 14, s)]
    # a chain: each links to the next only
    line = [f"c{i}" for i in range(100)]
    for step in range(6):
        texts.append(" ".join(f"n{step}x{i}" if i < 3 * step else w for i, w in enumerate(line)))
    _compare(spark, list(enumerate(texts)), k, percent)


def test_edges(spark):
    rows = [(5, "A b"), (2, "a B"), (9, "a"), (8, "a"), (1, None), (3, ""), (4, " \t\r\n"), (7, "x y z"), (7, "x y z"), (6, "X  Y\tZ"), (None, "lone text here"), (10, "no break space"), (11, "É é")]
    _compare(spark, rows, 3, 85)
    _compare(spark, [], 3, 85)


def test_sets_are_whole_texts():
    texts = ["", "a", "a b", "a b c", "a b c a b c", "  A\tB\nC  ", "é É é", "z " * 5000]
    values, of = shingle_sets([t.encode() for t in texts], 3)
    assert np.diff(of).tolist() == [len(_set(t, 3)) for t in texts]
    assert values[of[3]] == values[of[5]] and values[of[2]] != values[of[3]]


@pytest.mark.parametrize("size", [200, 3000, 20_000])
def test_sketch_bound_keeps_pairs_at_the_threshold(size):
    s = neardup.Settings(words=3, percent=85)
    rng = np.random.default_rng(5)
    for less in (0, size // 12):
        # sets of size and size - less with exactly the least intersection of a link
        both = -(-85 * (2 * size - less) // 185)
        bound = neardup.most_odd(np.array([size]), np.array([size - less]), s)[0]
        far = []
        for _ in range(200):
            held = rng.integers(0, 1 << 63, 2 * size - less - both, dtype=np.uint64)
            a, b = np.sort(held[:size]), np.sort(held[size - both :])
            _, odd = neardup.signatures(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), s)
            far.append(int(neardup.odd_bits(odd[0], odd[1])))
            assert far[-1] == sum(bin(x & (1 << 64) - 1).count("1") for x in (odd[0] ^ odd[1]).tolist())
        assert max(far) <= bound < 1.9 * np.mean(far)


def _edited_copies(n, seed):
    rng = random.Random(seed)
    first = [f"w{i}" for i in range(120)]
    for i in range(n):
        copy = list(first)
        for p in rng.sample(range(120), 2):
            copy[p] = f"x{i}y{p}"
        yield " ".join(copy)


def test_pairs_of_a_group_grow_with_its_size(spark, monkeypatch):
    """Copies of one text, each with two edits: most pairs share bands and many are links."""
    seen = []
    plain = neardup.materialise

    def counted(df, tag):
        out = plain(df, tag)
        if tag == "pairs":
            seen[-1] += out.count()
        return out

    monkeypatch.setattr(neardup, "materialise", counted)
    for n in (400, 800):
        seen.append(0)
        rows = list(enumerate(_edited_copies(n, 3)))
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(df, neardup.Settings(words=3, percent=85)).collect()}
        assert got == {d: c for (d, _), (_, c) in zip(rows, _brute(rows, 3, 85), strict=True)}
    assert seen[1] <= 2.5 * seen[0]


def test_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, "A b c d"), (None, "a b\tc d"), (None, ""), (5, "x y z"), (None, "x y z"), (4, "X y z"), (4, "x y  z")], "doc_id long, text string")
    got = neardup.near_duplicates(df, neardup.Settings(words=3, percent=85)).collect()
    assert sum(r["kept"] for r in got if r["component_id"] is None and r["n_shingles"]) == 1
    assert sorted((r["doc_id"], r["kept"]) for r in got if r["component_id"] == 4 and r["doc_id"]) == [(4, True), (4, True), (5, False)]
    assert sum(r["first"] for r in got if r["component_id"] == 4) == 1
    assert neardup.drop_near_duplicates(df, neardup.Settings(words=3, percent=85)).count() == 3


def test_stage_keeps_one_row_and_all_columns(spark):
    rows = [(1, "a b c d e f", 1), (2, "a b c d e f", 2), (3, "g h i", 3), (3, "g h i", 3), (4, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `set` int")
    left = neardup.drop_near_duplicates(df, neardup.Settings(words=5, percent=80))
    assert left.columns == df.columns and sorted(r[0] for r in left.collect()) == [1, 3, 4]


def test_query(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {d: b for (d, _), b in zip(rows, _brute(rows, 3, 85), strict=True)}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op8_neardup(spark, sf).collect()}
    assert got == want


def test_many_tiny_texts_in_one_batch(spark):
    rows = [(i, f"a{i % 1500} b c d" if i % 7 else "") for i in range(3000)]
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), neardup.Settings(words=3, percent=85)).collect()}
    first: dict[str, int] = {}
    for i, t in rows:
        first.setdefault(t, i)
    assert got == {i: first[t] if t else i for i, t in rows}
