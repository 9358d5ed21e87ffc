from __future__ import annotations

from plumbline.llm import linededup, queries

LONG = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(55))


def _run(spark, rows, settings=None, kinds="doc_id long, text string"):
    return {(r["doc_id"], r["_lines"]): (r["text"], r["_dropped"]) for r in linededup.drop_lines(spark.createDataFrame(rows, kinds), settings).collect()}


def test_long_passage_goes_from_all_but_the_first(spark):
    got = _run(spark, [(2, f"own two\n{LONG}\nend"), (1, f"{LONG}\nown one"), (3, f"a\n\n{LONG}"), (4, "only mine")])
    assert got == {(1, 2): (f"{LONG}\nown one", 0), (2, 3): ("own two\nend", 1), (3, 3): ("a\n", 1), (4, 1): ("only mine", 0)}


def test_short_lines_need_more_documents(spark):
    four = [(i, f"common short line\nown {chr(97 + i)}") for i in range(4)]
    assert all(d == 0 for _, d in _run(spark, four).values())
    five = [*four, (9, "common short line\nown z")]
    got = _run(spark, five)
    assert got[0, 2][1] == 0 and sum(d for _, d in got.values()) == 4


def test_variable_fields(spark):
    # numbers are fields at once; other fields by the leaf's pattern
    rows = [(i, f"user {i} logged in from host{i} at 10:0{i} today\nown {'abcdefg'[i]}") for i in range(6)]
    assert sum(d for _, d in _run(spark, rows).values()) == 5
    names = "anna berta carla dora emma frida".split()
    rows = [(i, f"the daily report was written by {n} for the whole team\nown {n}") for i, n in enumerate(names)]
    assert sum(d for _, d in _run(spark, rows).values()) == 5
    # lines of one leaf that agree at few positions stay apart
    rows = [(i, f"the daily report {n} {n} {n} {n} {n} {n}\nown {n}") for i, n in enumerate(names)]
    assert sum(d for _, d in _run(spark, rows).values()) == 0


def test_several_templates_in_a_leaf(spark):
    names = "anna berta carla dora emma frida".split()
    a = [(i, f"the daily report was written by {n} for the whole team\nown {n}") for i, n in enumerate(names)]
    b = [(10 + i, f"the daily report went out with {n} after some long delay\nmine {n}") for i, n in enumerate(names[:5])]
    assert sum(d for _, d in _run(spark, b).values()) == 4
    got = _run(spark, a + b)
    assert sum(d for (i, _), (_, d) in got.items() if i < 10) == 5 and sum(d for (i, _), (_, d) in got.items() if i >= 10) == 4
    # of one size: the leaf's pattern mixes both
    assert sum(d for _, d in _run(spark, a[:5] + b).values()) == 8


def test_a_passage_over_several_lines(spark):
    words = [f"term{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    wrapped = [" ".join(words[a : a + 20]) for a in (0, 20, 40)]
    two = [(1, "\n".join(["start", *wrapped, "end of one"])), (2, "\n".join(["mine", *wrapped])), (3, "\n".join([wrapped[0], "between", *wrapped[1:]]))]
    got = _run(spark, two)
    # of the third only the pair that it shares, which is too short alone
    assert got == {(1, 5): (two[0][1], 0), (2, 4): ("mine", 3), (3, 4): (two[2][1], 0)}
    short = [(i, "\n".join([*wrapped[:2], f"own {'abc'[i]}"])) for i in range(3)]
    assert sum(d for _, d in _run(spark, short).values()) == 0
    # copies of one id are one document each; blank lines end a passage
    again = [(4, "\n".join(wrapped)), (4, "\n".join(wrapped)), (5, "\n".join([*wrapped[:2], "", wrapped[2]]))]
    assert sorted(d for _, d in _run(spark, again).values()) == [0, 0]


def test_edges(spark):
    rows = [(1, None, 7), (2, "", 7), (None, f"{LONG}\nx", 7), (3, LONG, 7), (3, LONG, 7), (4, f"{LONG}\n{LONG}", 7), (5, "\n \n", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, leaf int")
    got = linededup.drop_lines(df).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "leaf", "_lines", "_dropped"} and len(got) == 6
    text = {}
    for r in got:
        text.setdefault(r["doc_id"], []).append(r["text"])
    assert text == {2: [""], None: ["x"], 3: [LONG, LONG], 4: [""], 5: ["\n \n"]}
    assert linededup.drop_lines(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, sf):
    plan = linededup.drop_lines(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_query(spark, sf, duck, same):
    assert same(queries.op3_linededup(spark, sf), duck, queries.ORACLE["op3_linededup"]) > 1
