"""Distinct items at several grains, from words of bits."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from plumbline.functions.distinct import by_level, by_prefix, item_words


def _rows(spark, n=800):
    rng = random.Random(5)
    rows = [(rng.choice(["x", "y", None]), rng.choice(["p", "q", None]), rng.choice([None, -1, -64, -65, 0, 63, 64, 2**62, -(2**63), *range(200)]), rng.randrange(9)) for _ in range(n)]
    return spark.createDataFrame(rows, "a string, b string, item long, n int").selectExpr("a", "b", "item", "CAST(n AS DECIMAL(20,4)) AS amt")


def test_levels_are_those_of_rollup(spark):
    df = _rows(spark)
    got = by_level(df, ["a", "b"], "item", ["amt"])
    want = df.rollup("a", "b").agg(F.grouping_id().cast("int").alias("gid"), F.count_distinct("item").alias("items"), F.sum("amt").alias("amt"))
    rows = lambda d: sorted(((r["a"], r["b"], r["gid"], r["items"], r["amt"]) for r in d.collect()), key=repr)
    assert rows(got) == rows(want)
    assert rows(by_level(df, ["a", "b"], "item", ["amt"], least=1)) == rows(want.where("gid < 3"))
    assert by_level(df.limit(0), ["a", "b"], "item", ["amt"]).count() == 0


def test_prefixes(spark):
    df = _rows(spark).select("item", "amt", F.when(F.col("a").isNotNull(), F.expr("filter(array(a, b, IF(item > 100, 'r', NULL)), x -> x IS NOT NULL)")).otherwise(F.array().cast("array<string>")).alias("path"))
    got = {tuple(r["path"]): (r["items"], r["amt"]) for r in by_prefix(df, "path", "item", ["amt"]).collect()}
    want: dict = {}
    for r in df.collect():
        for d in range(1, len(r["path"]) + 1):
            items, amt = want.setdefault(tuple(r["path"][:d]), [set(), 0])
            items.add(r["item"])
            want[tuple(r["path"][:d])][1] = amt + r["amt"]
    assert got == {k: (len(i - {None}), a) for k, (i, a) in want.items()}
    assert by_prefix(df.limit(0), "path", "item", ["amt"]).count() == 0


def test_items_are_shuffled_once(spark):
    df = _rows(spark)
    plan = item_words(df, ["a", "b"], "item", ["amt"])._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1 and "Expand" not in plan
    # what comes after it reads words, not items
    after = by_level(df, ["a", "b"], "item", ["amt"])._jdf.queryExecution().executedPlan().toString()
    assert "item" not in after.replace("items", "") and "Expand" not in after
