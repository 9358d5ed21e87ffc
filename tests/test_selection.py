"""Exact quantiles by distributed selection."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions.selection import exact_quantiles, quantiles, ranked_part

AT = {"low": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "high": 1.0}


def test_as_percentile_gives_them(spark):
    rng = np.random.default_rng(1)
    rows = [("a", float(x)) for x in rng.normal(size=501)] + [("b", 7.0)] * 40 + [("c", 1.0), ("c", 2.0), ("d", 3.5), ("e", None), (None, 1.0), (None, None), (None, 4.0)] + [("f", float(x)) for x in rng.integers(0, 3, 100)]
    df = spark.createDataFrame(rows, "k string, v double")
    want = {r["k"]: tuple(r)[1:] for r in df.where("v IS NOT NULL").groupBy("k").agg(*(F.percentile("v", F.lit(q)).alias(n) for n, q in AT.items())).collect()}
    for accuracy in (10_000, 20, 2):  # cuts that bracket nothing change nothing
        assert {r["k"]: tuple(r)[1:] for r in exact_quantiles(df, ["k"], "v", AT, accuracy).collect()} == want
    assert exact_quantiles(df.where("false"), ["k"], "v", AT).count() == 0
    assert {r["k"] for r in quantiles(df, ["k"], "v", {"m": 0.5}, 100).collect()} >= {"a", "b"}


def test_two_keys_and_names_of_columns(spark):
    df = spark.createDataFrame([(i % 2, None if i % 3 else "x", i) for i in range(60)], "a int, `b c` string, v int")
    got = exact_quantiles(df.withColumnRenamed("b c", "b"), ["a", "b"], "v", {"m": 0.5}).collect()
    assert len(got) == 4
    for r in got:
        assert r["m"] == np.median([i for i in range(60) if i % 2 == r["a"] and (r["b"] == "x") == (i % 3 == 0)])


@pytest.mark.parametrize("expr", ["42D", "CAST(id * 7919 % 1000003 AS DOUBLE)", "CAST(IF(id % 3 = 0, 5, id) AS DOUBLE)"])
def test_a_large_group_is_ranked_in_a_small_part(spark, expr):
    n = 1_000_000
    df = spark.range(n).selectExpr("1 AS k", f"{expr} AS v")
    want = {"m": 0.5, "p": 0.9}
    _, part = ranked_part(df, ["k"], "v", want, 1000)
    held = part.groupBy("k", "_b").count().agg(F.max("count")).first()[0]
    # of a million values some thousands are ranked together
    assert held <= 8 * n // 1000 and part.agg(F.count("*")).first()[0] <= 4 * 8 * n // 1000
    got = exact_quantiles(df, ["k"], "v", want, 1000).first()
    values = np.sort(df.select("v").toPandas()["v"].to_numpy())
    assert (got["m"], got["p"]) == pytest.approx((np.quantile(values, 0.5), np.quantile(values, 0.9)), abs=1e-6)
