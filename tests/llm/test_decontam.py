from __future__ import annotations

import pickle
import random
import time

import numpy as np
import pytest

from plumbline.llm import decontam, queries

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _distance(a, b):
    """Least edit distance of a to any part of b."""
    prev = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return min(prev)


def test_bit_parallel_distance_is_exact():
    rng = random.Random(4)
    for _ in range(300):
        a = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
        b = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 30)))
        want = _distance(a, b)
        for most in (0, 2, 99):
            assert decontam.edits_within(a, b, most) == (want if want <= most else None)


def _edited(text, n, rng):
    t = list(text)
    for _ in range(n):
        p, how = rng.randrange(len(t)), rng.random()
        if how < 0.34:
            t[p] = rng.choice(LETTERS)
        elif how < 0.67:
            del t[p]
        else:
            t.insert(p, rng.choice(LETTERS))
    return "".join(t)


def _sentence(rng, n):
    return " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_target_recall_under_edits():
    rng = random.Random(11)
    items = [(i, _sentence(rng, rng.randint(14, 60)).encode()) for i in range(100)]
    index = decontam.Index(items, decontam.Settings())
    for share, least in ((0.0, 1.0), (0.02, 0.98), (0.05, 0.95), (0.08, 0.93), (0.12, 0.85)):
        found = 0
        for i, t in items:
            text = f"{_sentence(rng, 200)} {_edited(t.decode(), int(share * len(t)), rng)} {_sentence(rng, 200)}"
            got = decontam.matches([text.encode()], index)
            assert {j for _, j, _ in got} <= {i}
            found += bool(got)
        assert found >= least * len(items), share


@pytest.mark.parametrize("words", [(2, 5), (6, 10), (14, 60)])
def test_recall_up_to_the_accepted_share(words):
    rng = random.Random(12)
    items = [(i, _sentence(rng, rng.randint(*words)).encode()) for i in range(120)]
    index = decontam.Index(items, decontam.Settings())
    for share in (0.0, 0.03, 0.06, 0.1, 0.12, 0.15, 0.18, 0.2):
        texts = [f"{_sentence(rng, 100)} {_edited(t.decode(), int(share * len(t)), rng)} {_sentence(rng, 100)}".encode() for _, t in items]
        got = {(d, i) for d, i, _ in decontam.matches(texts, index)}
        assert sum((i, i) in got for i in range(len(items))) >= 0.9 * len(items), share


def test_distances_of_many_pairs_are_exact():
    rng = random.Random(8)
    flat = np.array([rng.choice(b"abc ") for _ in range(2000)], np.uint8)
    buf = np.array([rng.choice(b"abc ") for _ in range(3000)], np.uint8)
    at, size = np.array([rng.randrange(1900) for _ in range(150)]), np.array([rng.randint(1, 64) for _ in range(150)])
    begin, length = np.array([rng.randrange(2800) for _ in range(150)]), np.array([rng.randint(0, 90) for _ in range(150)])
    got = decontam.edits_of_many(flat, at, size, buf, begin, length, step=64)
    for k in range(150):
        assert got[k] == _distance(flat[at[k] : at[k] + size[k]].tobytes(), buf[begin[k] : begin[k] + length[k]].tobytes())


def test_what_repeats_takes_linear_time():
    item = b"na " * 20 + b"end"
    index = decontam.Index([(1, item), (2, b"la " * 40)], decontam.Settings())
    took = []
    for n in (20_000, 80_000):
        start = time.process_time()
        got = dict(((d, i), e) for d, i, e in decontam.matches([b"na " * (n // 3) + b"end", b"lo " * 50 + b"la " * (n // 3)], index))
        took.append(time.process_time() - start)
        assert got[0, 0] == 0 and got[1, 1] == 0
    assert took[1] < 8 * took[0] + 1


def test_a_match_further_on_is_not_skipped():
    rng = random.Random(9)
    # an item that is nearly periodic, in a text where its best place is not the first
    item = ("ab cd ef gh " * 8).strip()
    index = decontam.Index([(1, item.encode())], decontam.Settings())
    for _ in range(20):
        text = f"{_sentence(rng, 10)} {_edited(item, 16, rng)} {'ab cd ef gh ' * rng.randrange(3)}{item} {_sentence(rng, 5)}"
        assert decontam.matches([text.encode()], index) == [(0, 0, 0)]


def test_an_index_is_bounded(spark):
    rng = random.Random(10)
    items = [(i, _sentence(rng, 40)) for i in range(60)]
    df = spark.createDataFrame(items, "item_id long, text string")
    s = decontam.Settings(block_bytes=3000)
    paths = decontam.indexes(df, s)
    held = [decontam._read(p) for p in paths]
    assert sorted(i for x in held for i in x.ids) == list(range(60)) and len(paths) > 3
    assert max(sum(map(len, x.texts)) for x in held) <= 3000
    big = decontam.Index([(i, t.encode()) for i, t in items], decontam.Settings())
    # tables of a bound for each size and direction of windows, and what grows
    assert len(pickle.dumps(big)) < len(big.groups) * (20 << 20) + 250 * sum(len(t) for _, t in items)


def test_tiny_items_are_whole_words():
    index = decontam.Index([(1, b"abc"), (2, b"To be!"), (3, b"?"), (4, "né".encode())], decontam.Settings())
    texts = ["abc", "x abc y", "abcd", "xabc", "to-be or not", "not to be", "to bee", "", "né-il", "abc abc"]
    assert sorted((d, i) for d, i, e in decontam.matches([t.encode() for t in texts], index) if e == 0) == [(0, 0), (1, 0), (4, 1), (5, 1), (8, 3), (9, 0)]


def test_item_without_its_first_word_begins_a_text():
    rng = random.Random(5)
    item = "extraordinary " + _sentence(rng, 30)
    index = decontam.Index([(1, item.encode())], decontam.Settings())
    cut = item.split(" ", 1)[1].encode()
    texts = [_sentence(rng, 40).encode(), cut, cut + b" " + _sentence(rng, 40).encode(), _sentence(rng, 40).encode()]
    assert sorted(d for d, _, _ in decontam.matches(texts, index)) == [1, 2]
    assert [d for d, _, _ in decontam.matches([cut], index)] == [0]


def test_item_inside_text_without_spaces():
    rng = random.Random(6)
    for script in ("".join(map(chr, range(0x4E00, 0x5000))), "".join(map(chr, range(0xE01, 0xE2F))), "".join(map(chr, range(0x3042, 0x3090)))):
        run = lambda n: "".join(rng.choice(script) for _ in range(n))
        item = run(60)
        index = decontam.Index([(1, item.encode())], decontam.Settings())
        cut = item[:20] + run(2) + item[22:]
        texts = [run(300), run(151) + item + run(151), run(150) + cut + run(150), run(10) + "\uff0cABC" + item]
        got = {d: e for d, _, e in decontam.matches([t.encode() for t in texts], index)}
        assert got.keys() == {1, 2, 3} and got[1] == got[3] == 0
    # words after signs of scripts that do have spaces
    item = _sentence(rng, 30)
    index = decontam.Index([(1, item.encode())], decontam.Settings())
    assert decontam.matches([f"mot «{item}» mot".encode(), f"word \u201c{item}\u201d word".encode()], index) == [(0, 0, 0), (1, 0, 0)]


def test_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    plain = lambda t: " ".join("".join(c if c.isalnum() and c.isascii() or ord(c) > 127 else " " for c in (t or "").lower()).split())
    texts = {r["item_id"]: plain(r["text"]) for r in items}
    want = {(d["doc_id"], i) for d in docs for i, t in texts.items() if f" {t} " in f" {plain(d['text'])} "}
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in queries.op2_decontam(spark, sf).collect()}
    assert want and want <= set(got)
    for (d, i), edits in got.items():
        if (d, i) not in want:
            text = plain(next(x["text"] for x in docs if x["doc_id"] == d))
            assert _distance(texts[i].encode(), text.encode()) <= edits <= 0.2 * len(texts[i].encode())


def test_case_punctuation_short_items_and_edges(spark):
    items = spark.createDataFrame([(1, "What is the capital city of the northern province of Ardenia, in 1804?"), (2, "tiny"), (3, None), (4, "A short one, here"), (5, "what IS the capital city of the northern province of ardenia in 1804")], "item_id long, text string")
    rows = [(1, "xx WHAT IS THE CAPITAL -- city of the northern province of Ardenia in 1804!! yy"), (2, "tiny"), (3, None), (4, ""), (5, "say: a short one -- here. end"), (None, "a short one here"), (6, "what is the capital city"), (5, "say: a short one -- here. end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, items).collect()]
    assert sorted(got, key=repr) == sorted([(1, 1), (1, 5), (2, 2), (5, 4), (5, 4), (None, 4)], key=repr)
    blocks = decontam.contaminated(docs, items, decontam.Settings(block_bytes=1)).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in blocks), key=repr) == sorted(got, key=repr)
    left = decontam.drop_contaminated(docs.withColumnRenamed("doc_id", "doc_id").selectExpr("*", "1 AS _i", "2 AS row"), items)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 6]
    assert decontam.contaminated(docs.limit(0), items).count() == 0 and decontam.contaminated(docs, items.limit(0)).count() == 0
