"""What is shuffled or read again grows with the input: plans that must not come back."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from plumbline.operators import arrival, screen
from plumbline.plans import monthly
from plumbline.plans.monthly import QUERIES
from plumbline.sources.sales import SALES, base, both_pushes, current_push, previous_push, sales_view


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(df) -> int:
    return _plan(df).count("FileScan parquet [l_orderkey")


def test_a_base_shuffles_lines_to_their_order_and_item_only(spark, sf):
    plan = _plan(base(current_push(sales_view(spark, sf))))
    assert not re.search(r"Exchange hashpartitioning\([^)]*month", plan)
    assert len(re.findall(r"Exchange hashpartitioning\(l_", plan)) == 2


def test_repeated_keys_of_two_pushes_meet_each_with_each(spark):
    side = lambda *rows: spark.createDataFrame(list(rows), "month int, item int, q int, amt int").selectExpr("month", "item", "q", "CAST(amt AS DECIMAL(20,4)) AS amt")
    cur = side((1, 1, 1, 5), (1, 1, 2, 7), (1, None, 1, None), (1, 3, 1, 4))
    prev = side((1, 1, 1, 6), (1, 1, None, 1), (1, None, 1, 2), (1, 4, 1, 9))
    got = {r["status"]: (r["keys"], r["effect"]) for r in arrival.push_diff(cur, prev, ["month", "item"], ["q"]).collect()}
    assert got == {"same": (2, -1 - 2.0), "changed": (3, 4.0 + 1.0 + 6.0), "added": (1, 4.0), "removed": (1, -9.0)}


def test_parts_that_differ_are_looked_up_where_the_rows_are(spark):
    df = spark.range(1000).selectExpr("id % 3 AS month", "id AS item", "id AS q", "CAST(id AS DECIMAL(20,4)) AS amt")
    parts = arrival.changed_parts(*(arrival.push_tree(d, ["month", "item"], ["q"], ["month"]) for d in (df, df.where("item <> 5"))))
    found = arrival.only_parts(df, parts, ["month", "item"])
    assert "Broadcast" in _plan(found) and "SortMergeJoin [" not in _plan(found).split("BroadcastExchange")[0]
    assert 5 in {r["item"] for r in found.collect()}


@pytest.mark.parametrize("name", ["B1_arrival", "B5_restatement", "F1_price_summary", "H5_swallowed_families", "H6_split_families", "J1_label_sample", "M1_screen"])
def test_the_source_is_read_once(spark, sf, name):
    assert _scans(QUERIES[name](spark, sf)) == 0  # what is told is made of what that one pass wrote


def test_both_trees_are_landed_in_one_pass(spark, sf, monkeypatch):
    landed, real = [], monthly.written
    monkeypatch.setattr(monthly, "written", lambda df, tag: landed.append(df) or real(df, tag))
    assert _scans(QUERIES["B5_restatement_by_tree"](spark, sf)) == 0
    assert [_scans(df) for df in landed] == [1] and landed[0].columns == ["push", "month", "part", "rows", "checksum", "amt"]


@pytest.mark.parametrize("name", ["M3_impact_of_grains", "M3_module_impact"])
def test_flags_of_all_grains_and_their_rows_come_of_one_pass(spark, sf, monkeypatch, name):
    landed, real = [], monthly.written
    monkeypatch.setattr(monthly, "written", lambda df, tag: landed.append(df) or real(df, tag))
    assert _scans(QUERIES[name](spark, sf)) == 0
    assert [_scans(df) for df in landed] == [1]


def test_rows_of_both_pushes_are_those_of_each(spark, sf):
    w = sales_view(spark, sf)
    both = both_pushes(w)
    assert [(f.name, f.dataType) for f in both.drop("push").schema] == [(f.name, f.dataType) for f in SALES]
    for push, rows in (("current", current_push(w)), ("previous", previous_push(w))):
        got = both.where(F.col("push") == push).drop("push")
        assert rows.exceptAll(got).count() == got.exceptAll(rows).count() == 0
    assert both.count() == current_push(w).count() + previous_push(w).count()


def test_short_lists_of_flags_move_no_rows(spark):
    df = spark.range(100).selectExpr("CAST(id % 5 AS STRING) AS country", "id AS item", "CAST(1 AS DECIMAL(20,4)) AS amt")
    flags = spark.createDataFrame([("m", '{"country":"1"}'), ("n", '{"item":7}')], "module string, key string")
    assert "SortMergeJoin" not in _plan(screen.module_impact(df, flags, ["country"]))
    sums = {(r["module"], r["country"]): r["rows"] for r in screen.module_impact(df, flags, ["country"]).collect()}
    assert sums == {("m", "1"): 20, ("n", "2"): 1}
