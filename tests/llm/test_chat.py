from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import chat, queries

TURNS = "conv_id long, turn long, role string, text string"


def _back(spark, rows):
    df = chat.parse_chat(chat.format_chat(spark.createDataFrame(rows, TURNS)))
    return {r["conv_id"]: ([(t["role"], t["text"]) for t in r["turns"]], list(r["learnt"]), r["formatted"]) for r in df.collect()}


def test_merges_adjacent_turns_and_reads_back(spark):
    got = _back(spark, [(1, 2, "user", "c"), (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 3, "assistant", "d"), (1, 4, "assistant", "</s>[INST] ok [/INST]")])[1]
    assert got[0] == [("user", "a"), ("user", "b"), ("user", "c"), ("assistant", "d"), ("assistant", "</s>[INST] ok [/INST]")]
    assert got[1] == ["d", "</s>[INST] ok [/INST]"]
    assert got[2].startswith("<s>user[INST]a[/INST]b[/INST]c</s><s>assistant[INST]d[/INST]") and got[2].count("<s>") == 2


def test_nulls_and_empty(spark):
    got = _back(spark, [(1, None, None, None), (None, 0, "user", ""), (None, 0, "user", ""), (2, 0, "assistant", "")])
    assert got[1][0] == [("", "")] and got[None][0] == [("user", ""), ("user", "")] and got[2][1] == [""]
    assert _back(spark, []) == {}


_PIECES = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "/", "s>", "é", "\n", "<\\s>", "[\\\\INST]", "$1", "x"]), max_size=8).map("".join)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(_PIECES, _PIECES), min_size=1, max_size=60))
def test_any_text_comes_back(spark, pairs):
    rows = [(i, 0, r, t) for i, (r, t) in enumerate(pairs)]
    got = _back(spark, rows)
    assert {i: g[0] for i, g in got.items()} == {i: [(r, t)] for i, _, r, t in rows}


def test_query(spark, sf, duck, same):
    assert same(queries.op6_chat(spark, sf), duck, queries.ORACLE["op6_chat"]) > 1
