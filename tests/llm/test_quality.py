from __future__ import annotations

import math
import random

import numpy as np
import pytest

from plumbline.llm import quality, queries


def test_em_finds_the_labellers_rates():
    rng = np.random.default_rng(2)
    truth = rng.random(40_000) < 0.2
    rates = np.array([[0.02, 0.05, 0.01, 0.1], [0.8, 0.6, 0.5, 0.7]])
    votes = rng.random((40_000, 4)) < rates[truth.astype(int)]
    keys, counts = np.unique(votes @ (1 << np.arange(4)), return_counts=True)
    post, rate, prior = quality.expectation_maximisation(dict(zip(keys.tolist(), counts.tolist(), strict=True)), 4)
    assert prior == pytest.approx(0.2, abs=0.02) and np.abs(rate - rates).max() < 0.04
    told = np.array([post[k] for k in (votes @ (1 << np.arange(4))).tolist()]) > 0.5
    assert (told == truth).mean() > 0.93


def test_held_out_labels(spark):
    """Fitted without the labels of every other document, judged on those."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality.classify(docs, labels.where("doc_id % 2 = 0")).select("doc_id", "_kept").join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r["_kept"] for r in scored if r["quality"] == 1 and r["toxic"] == 0]
    junk = [r["_kept"] for r in scored if r["quality"] == 0]
    toxic = [r["_kept"] for r in scored if r["toxic"] == 1]
    assert np.mean(good) >= 0.97 and np.mean(junk) <= 0.1 and np.mean(toxic) <= 0.25


def test_held_out_labels_of_more_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality.classify(docs, labels.where("doc_id % 2 = 0")).select("doc_id", "_kept").join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    assert np.mean([r["_kept"] for r in scored if r["quality"] == 1 and r["toxic"] == 0]) >= 0.98
    assert np.mean([r["_kept"] for r in scored if r["quality"] == 0]) <= 0.05
    assert np.mean([r["_kept"] for r in scored if r["toxic"] == 1]) <= 0.1


def test_em_is_the_plain_one():
    """Over documents one by one, in plain Python, as over counts of patterns."""
    rng = random.Random(4)
    docs = [tuple(int(rng.random() < (0.7 if i % 4 == 0 else 0.1)) for _ in range(3)) for i in range(200)]
    post = [1 - 0.1 ** sum(v) for v in docs]
    for _ in range(200):
        mass = (sum(1 - p for p in post), sum(post))
        prior = mass[1] / len(docs)
        rate = [[(sum((p if c else 1 - p) * v[j] for p, v in zip(post, docs, strict=True)) + 0.01) / (mass[c] + 1) for j in range(3)] for c in (0, 1)]
        rate[0] = [min(x, 0.5) for x in rate[0]]
        like = [[(prior if c else 1 - prior) * math.prod(rate[c][j] if v[j] else 1 - rate[c][j] for j in range(3)) for c in (0, 1)] for v in docs]
        post = [b / (a + b) for a, b in like]
    counts: dict[int, int] = {}
    for v in docs:
        key = sum(x << j for j, x in enumerate(v))
        counts[key] = counts.get(key, 0) + 1
    got, rates, share = quality.expectation_maximisation(counts, 3)
    assert share == pytest.approx(prior, abs=1e-6) and rates == pytest.approx(np.array(rate), abs=1e-6)
    for v, p in zip(docs, post, strict=True):
        assert got[sum(x << j for j, x in enumerate(v))] == pytest.approx(p, abs=1e-6)


def test_scorer_is_the_plain_one():
    rng = random.Random(5)
    rows = [[(rng.randrange(40), rng.random()) for _ in range(rng.randint(1, 8))] for _ in range(30)]
    target = [rng.random() for _ in rows]
    w: dict[int, float] = {}
    seen: dict[int, float] = {}
    bias, up = quality.N_FEATURES, sum(target) / len(target)
    for _ in range(10):
        grad: dict[int, float] = {}
        for row, t in zip(rows, target, strict=True):
            p = 1 / (1 + math.exp(-sum(v * w.get(i, 0) for i, v in row) - w.get(bias, 0)))
            gap = (p - t) * (0.5 / max(up, 0.02) if t > 0.5 else 0.5 / max(1 - up, 0.02)) / len(rows)
            for i, v in [*row, (bias, 1)]:
                grad[i] = grad.get(i, 0) + gap * v
        for i, g in grad.items():
            g += 1e-5 * w.get(i, 0)
            seen[i] = seen.get(i, 1e-8) + g * g
            w[i] = w.get(i, 0) - 0.3 * g / math.sqrt(seen[i])
    flat = [x for row in rows for x in row]
    got = quality.train(np.array([i for i, _ in flat]), np.array([v for _, v in flat]), np.cumsum([0, *map(len, rows)]), np.array(target), epochs=10)
    assert got[[*w]] == pytest.approx(np.array([*w.values()]), abs=1e-9)


def test_labellers_of_toxicity_are_separate():
    words = [np.sort(np.array([quality.hash_word(w) for w in x], np.uint64)) for x in (["idiot"], ["zork"], ["blah", "blub"])]
    texts = ["calm idiot " + "word " * 150, "a zork " + "word " * 150, "blah " + "word " * 150 + " blub", "idiot zork", "blah " + "word " * 150 + " blah"]
    _, toxic = quality.patterns(quality.measure([t.encode() for t in texts], quality.Lexicon(*words)))
    assert toxic.tolist() == [1, 2, 4, 1 | 2 | 8 | 16, 0]


def test_measures_see_whole_texts():
    lexicon = quality.fixed_lexicon()
    m = quality.measure([b"", b"clean words in a line.", ("calm words here " * 4000 + "IDIOT").encode(), b"A| b | c | d", "é".encode()], lexicon)
    assert m.values["insults"].tolist()[:3] == [0, 0, 1 / 8]
    assert all(np.isfinite(v).all() for v in m.values.values())


def test_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Some calm words of a plain text, with a few more of them.", "x"), (3, "Some calm words of a plain text, with a few more of them.", "x"), (None, "you stupid idiot, pathetic loser", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, i string")
    got = quality.classify(df).collect()
    assert len(got) == 5 and got[0].asDict().keys() == {"doc_id", "text", "i", "_junk", "_toxic", "_kept"}
    assert [r["_kept"] for r in got if r["doc_id"] in (1, 2)] == [False, False]
    same = {(r["_junk"], r["_toxic"]) for r in got if r["doc_id"] == 3}
    assert len(same) == 1
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(df, none).count() == 5 and quality.classify(df.limit(0), none).count() == 0
    odd = spark.createDataFrame([(3, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert quality.classify(df, odd).count() == 5


def test_query_returns_the_kept(spark, sf):
    got = [r["doc_id"] for r in queries.op1_quality(spark, sf).collect()]
    assert 0 < len(got) < spark.read.parquet(f"{sf}/documents.parquet").count() and len(set(got)) == len(got)
