from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from plumbline.llm import prefixtrie, queries

TURNS = "conv_id long, turn long, role string, text string, conv string"


def _rebuilt(rows):
    convs: dict = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    low = lambda x: (x is not None, x or 0)
    digest = lambda r: hashlib.md5(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest()
    turns = {c: [(r[2] or "", r[3] or "") for r in sorted(held, key=lambda r: (low(r[1]), r[2] or "", digest(r)))] for c, held in convs.items()}
    out = {}
    for c, own in turns.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        out[c] = (turns.get(c - c % 100, []) if c is not None else [])[:h] + own[h:]
    return out


def _brute(rows):
    members: dict = {}
    whole = _rebuilt(rows)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    least = lambda ids: min((c for c in ids if c is not None), default=None)
    kids: dict = {}
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    out = []
    for k, ids in members.items():
        below = [u for u in members if u[: len(k)] == k]
        ends = sorted(c for c in ids if c is not None and len(whole[c]) == len(k))
        saved = sum((len(members[u]) - 1) * len(u[-1][1]) for u in below if u)
        out.append((least(ids), len(k), least(members[k[:-1]]) if k else None, len(ids), len(kids.get(k, [])), sum(u not in kids for u in below), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def _run(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x") for r in rows], TURNS)
    got = prefixtrie.conversation_trie(df, **more)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in got.select(names).collect()), key=repr)


def _random(n, seed):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(["", "yes", "no", "émile"])) for c in rng.sample(range(500), n) for t in range(rng.randrange(12))]


@pytest.mark.parametrize("most", [1, 6, prefixtrie.MOST])
def test_random_conversations(spark, most):
    rows = _random(40, 4)
    assert _run(spark, rows, most=most) == _brute(rows)


def test_edges(spark):
    rows = [
        (None, 0, "user", "a"), (None, None, None, "b"), (100, None, None, None), (100, 3, "user", "hi"), (100, 3, "user", "hi"), (100, -1, "user", "z" * 5000),
        (101, 5, "user", "turnless or not"), (102, 0, "user", "x"), (103, 0, "user", "x"), (950, 1, "user", "its hundred is absent"), (7, 0, "user", "x"), (7, 0, "assistant", ""),
    ]
    for most in (2, 100):
        assert _run(spark, rows, most=most) == _brute(rows)
    assert any(not t for t in _rebuilt(rows).values())
    assert _run(spark, []) == []


def test_a_chain_longer_than_a_piece(spark, monkeypatch):
    rows = [(c, t, "user", f"t{t % 7}") for c, n in ((100, 2500), (104, 40), (200, 3)) for t in range(n)]
    # components of at most 400 nodes of a chain: some rounds, each halving what is left
    got = _run(spark, rows, most=400)
    whole = _rebuilt(rows)
    assert len(got) == len({tuple(t[:d]) for t in whole.values() for d in range(min(len(t), 60) + 1)}) + len(whole[100]) - 60
    by = {(r[0], r[1]): r for r in got}
    deep = max(d for c, d in by if c == 100)
    assert deep == len(whole[100])
    # nodes of one member save nothing, and each has one leaf
    assert by[(100, deep)][4:7] == (0, 1, 0) and by[(100, deep - 1000)][4:7] == (1, 1, 0)
    assert by[(100, 0)][5] == sum(r[4] == 0 for r in got)


def test_centroid_sums():
    rng = random.Random(2)
    for n in (1, 2, 3, 50, 400):
        for shape in (1, 3, n):
            parent = [-1] + [rng.randrange(max(0, v - shape), v) for v in range(1, n)]
            # parents first, by depth, as the operator has them
            depth = [0] * n
            for v in range(1, n):
                depth[v] = depth[parent[v]] + 1
            order = sorted(range(n), key=lambda v: depth[v])
            at = {v: i for i, v in enumerate(order)}
            parent = [-1 if parent[v] < 0 else at[parent[v]] for v in order]
            value = [rng.randrange(100) for _ in range(n)]
            want = list(value)
            for v in range(n - 1, 0, -1):
                want[parent[v]] += want[v]
            assert prefixtrie.centroid_sums(parent, [value, [1] * n])[0] == want


def test_query(spark, sf, duck, same):
    assert same(queries.op13_trie(spark, sf), duck, queries.ORACLE["op13_trie"]) > 40
