"""Ids by pieces are the library's own; token files give random access."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm import common, packing, token_ids, tokenfile
from plumbline.llm.token_ids import Ids, cut

ODD = ["", " ", "\n", " a b", "a  b", "a\n\nb ", "tab\tand nbsp", "it's 'S <|endoftext|> x<|endoftext|>", "é é ΣΑΣ İ", "a ́b", "12345 !!! ...", "　x", "long" * 3000, "�\x00\x1c y", "a \n b", "ﬁ ½"]


FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
#: Two words of 1,024 characters whose polynomial hashes modulo 2 ** 64 are equal.
TWINS = ["".join("ab"[(i.bit_count() + k) % 2] for i in range(1024)) for k in (0, 1)]


def _library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def _same(coder, library, texts):
    ids, of = coder.encode([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert ids[of[i] : of[i + 1]].tolist() == library.encode(t, add_special_tokens=False).ids, repr(t[:50])


@pytest.mark.parametrize("name", FILES)
def test_pieces_give_the_librarys_ids(spark, sf, name):
    coder = Ids(public_tokenizers.path(name))
    texts = ODD + TWINS + [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect()]
    for _ in range(2):
        _same(coder, _library(name), texts)


@pytest.mark.parametrize("name", FILES)
def test_equal_hashes_of_different_pieces(monkeypatch, name):
    monkeypatch.setattr(token_ids, "hash_runs", lambda buf, a, b: np.where(b - a > 8, 7, buf[a]).astype(np.uint64))
    _same(Ids(public_tokenizers.path(name)), _library(name), [*TWINS, "a considerable difference, comparably", "b", "an a to tools", "difference"])


@pytest.mark.parametrize("name", FILES)
def test_long_texts_in_parts(monkeypatch, name):
    monkeypatch.setattr(token_ids, "PART_BYTES", 40)
    monkeypatch.setattr(token_ids, "cut", lambda t: cut(t, 40))
    texts = [*ODD[:8], "é\u00a0 x \u3000 y \u2003 z" * 30, "one  two\n\nthree four\tfive six's seven\n eight " * 20, "plain words of a text, and 12 more.\n" * 30]
    assert len(cut(texts[-1].encode(), 40)) > 5
    _same(Ids(public_tokenizers.path(name)), _library(name), texts)


@pytest.mark.parametrize("name", FILES)
def test_texts_without_spaces_are_held_in_bounds(monkeypatch, name):
    monkeypatch.setattr(token_ids, "KEPT_BYTES", 60_000)
    rng = np.random.default_rng(4)
    script = [chr(c) for c in range(0x4E00, 0x4F00)]
    unspaced = ["".join(rng.choice(script, 3400)) + "\nfin " + "".join(rng.choice(script, 200)) for _ in range(8)]
    words = [" ".join("".join(rng.choice(list("abcdef"), 9)) for _ in range(2500)) for _ in range(4)]
    coder = Ids(public_tokenizers.path(name))
    for part in ([unspaced[0], words[0], "", "a b"], unspaced[1:4] + words[1:3], [words[3], *unspaced[4:]]):
        _same(coder, _library(name), part)
        # pieces of ten thousand bytes aren't kept, and the table starts anew
        assert len(coder.raw) <= 60_000 + 25_000 * len(part) and coder.length.max(initial=0) <= token_ids.PIECE_BYTES


def test_any_token_without_its_neighbours():
    rng = np.random.default_rng(3)
    for high in (200, 50_000, 1 << 20):
        ids = rng.integers(0, high, 3000).astype(np.uint32)
        file = tokenfile.TokenFile(b"".join(tokenfile.dump([5, None, 7], [1000, 0, 2000], ids)))
        assert file.doc_ids == [5, None, 7] and file.starts.tolist() == [0, 1000, 1000, 3000]
        assert [file.token(i) for i in range(0, 3000, 7)] == ids[::7].tolist()
        for a, b in ((0, 0), (0, 3000), (511, 513), (1000, 2999), (2999, 3000)):
            assert file.span(a, b).tolist() == ids[a:b].tolist()
    assert tokenfile.TokenFile(b"".join(tokenfile.dump([], [], np.zeros(0, np.uint32)))).tokens == 0


def _docs(spark):
    rows = [(3, "b c", 1), (1, "hello world", 2), (None, "lost", 3), (2, None, 4), (2, "two", 5), (1, "hello world", 6)]
    return spark.createDataFrame(rows, "doc_id long, text string, start int")


def test_token_files(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = Ids(path)
    got = tokenfile.token_files(_docs(spark), path, file_tokens=4).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 1, 2, 2, 3]
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    assert {r["ids_crc32"] for r in got if r["doc_id"] == 1} == {zlib.crc32(np.array([*coder.whole("hello world"), 0], "<u4").tobytes())}
    assert tokenfile.token_files(_docs(spark).limit(0), path).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want, at = {}, 0
    for r in docs.orderBy("doc_id").collect():
        ids = np.array([*coder.library.encode(r["text"], add_special_tokens=False).ids, 0], "<u4")
        want[r["doc_id"]] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert {r["doc_id"]: tuple(r)[1:] for r in tokenfile.token_files(docs, path).collect()} == want


def test_plan_holds_every_piece_and_is_tight():
    rng = np.random.default_rng(1)
    for draw in (rng.integers(1, 2049, 5000), rng.integers(900, 1200, 3000), np.minimum(2048, rng.lognormal(6, 1.2, 8000).astype(int) + 1), np.array([2048, 1, 1])):
        histogram = {int(k): int(n) for k, n in zip(*np.unique(draw, return_counts=True), strict=True)}
        found = packing.plan(histogram, 2048)
        held: dict[int, int] = {}
        for key, m in found.configurations:
            assert sum(k * n for k, n in key) <= 2048
            for k, n in key:
                held[k] = held.get(k, 0) + n * m
        assert held == histogram
        count = np.zeros(2049, np.int64)
        for k, n in histogram.items():
            count[k] = n
        used = sum(m for _, m in found.configurations)
        assert found.bound <= used and -(-sum(k * n for k, n in histogram.items()) // 2048) <= found.bound
        assert used <= 1.01 * sum(packing.best_fit(count, 2048).values()) + 1
    assert packing.plan({}, 2048) == packing.Plan([], 0, 0.0, 0)


def test_the_fractional_program():
    """The solution is what it says, close to the dual bound, and needs the weights."""
    rng = np.random.default_rng(2)
    lognormal = np.minimum(2047, rng.lognormal(6, 1.2, 8000).astype(int) + 1)
    few = rng.choice([1100, 1080, 700, 701, 650, 350, 340, 300, 90], 4000)
    for draw, gap in ((lognormal, 0.03), (few, 0.07)):
        count = np.bincount(draw, minlength=2049)
        found = packing.solve_configurations(count, 2048)
        cover = np.zeros(2049)
        for key, m in found.used.items():
            assert m > 0 and sum(k * n for k, n in key) <= 2048
            for k, n in key:
                cover[k] += m * n
        at = np.flatnonzero(count)
        open_ = np.maximum(0, count - cover)[at] / (2048 // at)
        assert abs(sum(found.used.values()) + open_.sum() - found.value) < 1e-6 * found.value
        assert found.bound - 1e-6 <= found.value <= (1 + gap) * found.bound
        assert packing.solve_configurations(count, 2048, rate=0.0, rounds=10).value > 1.02 * found.value
        whole = packing.rounded(found.used, count)
        held = np.zeros(2049, np.int64)
        for key, m in whole.items():
            for k, n in key:
                held[k] += m * n
        assert (held <= count).all() and (draw is few or held.sum() >= 0.8 * count.sum())


def test_the_program_places_nearly_all(spark):
    """On the lengths of a real histogram: most pieces by the program, few by best-fit."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    found = packing.plan(histogram, 2048)
    assert found.by_program >= 0.9 * sum(n for k, n in histogram.items() if k < 2048)
    assert sum(m for _, m in found.configurations) == found.bound == -(-sum(k * n for k, n in histogram.items()) // 2048)


def test_a_hot_length_is_ranked_in_shares(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARE_ROWS", 7)
    cut = spark.range(200).selectExpr("id AS doc_id", "id AS row", "0 AS piece", "0L AS start", "CASE WHEN id < 150 THEN 40L ELSE 20L END AS length", "id AS ids_crc32")
    places: dict[int, list] = {}
    for r in packing.pack_pieces(cut, 100).collect():
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 100
    assert sum(map(len, places.values())) == 200 and len(places) == 75


def test_packing(spark, sf):
    path = public_tokenizers.path("word_bpe_49k.json")
    coder = Ids(path)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = packing.pack(docs, path, length=256).collect()
    ids = {r["doc_id"]: np.array([*coder.library.encode(r["text"], add_special_tokens=False).ids, 0], "<u4") for r in docs.collect()}
    back: dict[int, int] = {}
    places: dict[int, list] = {}
    for r in got:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert (len(part), zlib.crc32(part.tobytes())) == (r["length"], r["ids_crc32"]) and r["start"] == 256 * r["piece"]
        back[r["doc_id"]] = back.get(r["doc_id"], 0) + r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert back == {k: len(v) for k, v in ids.items()}
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 256
    assert len(places) <= 1.02 * -(-sum(back.values()) // 256) + 1
    odd = packing.pack(_docs(spark), path).collect()
    assert sorted((r["doc_id"] or -1, r["length"]) for r in odd)[0][0] == -1 and len(odd) == 6
    assert packing.pack(_docs(spark).limit(0), path).count() == 0


def test_scratch_is_shared(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = common.scratch(spark, "x")
    assert "://" in path and (base or "") in path
    df = common.materialise(spark.range(3).withColumn("x", F.lit("y")), "x")
    assert df.count() == 3
