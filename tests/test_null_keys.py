"""Keys with nulls: a table against itself has no difference, and no row is lost."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from plumbline.operators import arrival, brand, category, coverage, freeze, governance, labels, level, price, tail, tree

JUNE, MAY = datetime.date(2001, 6, 1), datetime.date(2001, 5, 1)
SITE = ["country", "platform"]


@pytest.fixture(scope="module")
def df(spark):
    rows = []
    for month in (MAY, JUNE):
        for i, (country, leaf, name) in enumerate([(None, "x", "Aa"), ("ASIA", None, None), ("ASIA", "x", "Bb"), (None, None, None), ("EUROPE", "y", "Aa")]):
            for item in (None if i == 4 else 10 + i, 20 + i):
                rows.append((month, country, "P", item, leaf, f"{name}/{i}" if name else None, name, 10, 100 * (i + 1)))
    df = spark.createDataFrame(rows, "month date, country string, platform string, item long, leaf string, raw_brand string, brand string, q int, a int")
    return df.withColumns({"qty": F.col("q").cast("decimal(18,2)"), "amt": F.col("a").cast("decimal(20,4)"), "node": F.lit(None).cast("int"), "root": F.lit(None).cast("int")}).drop("q", "a").persist()


def test_a_push_against_itself_is_the_same(df):
    key = ["month", *SITE, "item"]
    assert {r["status"] for r in arrival.push_diff(df, df, key, ["qty", "amt"]).collect()} == {"same"}
    assert [r["ratio"] for r in arrival.restatement(df, df, ["month", "country"]).collect()] == [1.0] * 6
    assert [r["ratio"] for r in governance.release_compare(df, df, ["country", "leaf"]).collect()] == [1.0] * 5
    assert {r["state"] for r in governance.item_recon(df, df, [*SITE, "item"]).collect()} == {"open"}
    assert tree.tree_diff(df, df).count() == 0
    truth = df.withColumnRenamed("amt", "true_amt")
    got = governance.own_compare(df, truth, ["month", *SITE, "item"], ["month"]).collect()
    assert [(r["only_estimate"], r["only_truth"], r["p90"]) for r in got] == [(0, 0, 0.0)] * 2
    assert {r["country"]: r["times"] for r in governance.flag_history(df, df, ["country"]).collect()} == {None: 8, "ASIA": 8, "EUROPE": 4}


def test_equal_months_show_no_change(df):
    for r in level.period_change(df, SITE, months=(1,)).where(F.col("month") == F.lit(JUNE)).collect():
        assert r["change_1"] == 0
    for r in coverage.coverage_split(df, "2001-06-01", "2001-05-01", ["country"]).collect():
        assert (r["added"], r["lost"], r["change"]) == (0, 0, 0)
    assert {(r["by_count"], r["by_mean"]) for r in coverage.count_mean_split(df, "2001-06-01", "2001-05-01", ["country"]).collect()} == {(0, 0)}
    assert {r["change"] for r in coverage.volume_price_split(df, "2001-06-01", "2001-05-01", ["country"]).collect()} == {0}
    assert {r["shift"] for r in category.band_shift(df, [5.0], ["leaf"], "2001-06-01", "2001-05-01").collect()} == {0}
    assert {(r["entries"], r["exits"], r["overlap"]) for r in tail.head_turnover(df, ["country"], 2, "2001-06-01", "2001-05-01").collect()} == {(0, 0, 1.0)}
    for r in brand.leaf_top_brands(df, "leaf", "2001-06-01", "2001-05-01").collect():
        assert r["rank"] == r["base_rank"]
    last_year = df.withColumn("month", F.add_months("month", -12)).union(df)
    assert {r["change"] for r in brand.others_yoy(last_year, ["country"]).where(F.col("month") >= F.lit(MAY)).collect()} == {0}


def test_groups_of_a_null_key_are_kept(df):
    n = df.select("leaf").distinct().count()
    for got in (price.price_summary(df, ["leaf"]), tail.item_concentration(df, ["leaf"]), tail.tail_profile(df, ["leaf"])):
        assert got.count() == n
    assert labels.label_sample(df, "leaf", 1).where("leaf IS NULL").count() > 0
    frozen = df.where("country IS NULL")
    assert freeze.intake(df.withColumn("text", F.lit("")), frozen, ["country"]).where("country IS NULL").count() == 0
    assert freeze.apply_scope(df, frozen, ["country"]).count() == frozen.count()


def test_tail_profile_by_bins_is_the_running_sum(spark):
    rows = [(k, i, float((i * 7919 * (ord(k) - 90)) % 1000 - (50 if k == "c" else 0))) for k in "abc" for i in range(300)] + [("d", 1, 0.0), (None, 1, 5.0), (None, 2, 5.0)]
    df = spark.createDataFrame(rows, "k string, item long, a double").selectExpr("k", "item", "CAST(a AS DECIMAL(20,4)) AS amt", "CAST(1 AS DECIMAL(18,2)) AS qty")
    got = {r["k"]: (r["items"], r["head_items"], r["tail_items"]) for r in tail.tail_profile(df, ["k"], 0.8, 100.0).collect()}
    want: dict = {}
    for key in {k for k, _, _ in rows}:
        held = sorted((a for k, _, a in rows if k == key), reverse=True)
        upto, head = 0.0, 0
        for a in held:
            head += upto < 0.8 * sum(held)
            upto += a
        want[key] = (len(held), head, sum(a < 100 for a in held))
    assert got == want


def test_declared_and_corrected(spark):
    flags = spark.createDataFrame([(JUNE, None, "P", 1), (JUNE, "ASIA", "P", 2), (MAY, "ASIA", "P", 3)], "month date, country string, platform string, item long")
    told = spark.createDataFrame([("ASIA", None, JUNE, JUNE), ("ASIA", "P", JUNE, JUNE)], "country string, platform string, from_month date, to_month date")
    assert {r["item"]: r["state"] for r in governance.downgrade(flags, told, SITE).collect()} == {1: "open", 2: "explained", 3: "open"}
    fixes = spark.createDataFrame([(1, "no_such_column", "v")], "item long, field string, wanted string")
    df = flags.withColumn("amt", F.lit(1).cast("decimal(20,4)"))
    assert [r["state"] for r in governance.carry_over(df, fixes).collect()] == ["not applicable"]


def test_frozen_again_is_there_once(spark, tmp_path):
    t = spark.range(3)
    for _ in range(2):
        freeze.freeze({"t": t}, "r", str(tmp_path))
        freeze.land(t, "r", "v", "range(3)", str(tmp_path))
    freeze.freeze({"t": t}, "s", str(tmp_path))
    assert freeze.thaw(spark, "t", "r", str(tmp_path)).count() == 3 and freeze.thaw(spark, "t", "s", str(tmp_path)).count() == 3
    assert spark.read.parquet(f"{tmp_path}/catalog").count() == 1
