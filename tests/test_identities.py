"""Identities that hold for any data: parts add up, shares are whole, states
part their keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline.operators import arrival, category, coverage, freeze, governance, level
from plumbline.sources.sales import SITE, base, current_push, load_sales, previous_push, sales_view

MONTH, BASE_MONTH = "2001-06-01", "2001-05-01"


@pytest.fixture(scope="module")
def w(spark, sf):
    return base(sales_view(spark, sf)).persist()


def test_splits_add_up(w):
    for r in coverage.coverage_split(w, MONTH, BASE_MONTH, SITE).collect():
        assert r["added"] - r["lost"] + r["matched"] == pytest.approx(r["change"], abs=1e-6)
    for r in coverage.volume_price_split(w, MONTH, BASE_MONTH, ["l2"]).collect():
        assert r["by_volume"] + r["by_price"] == pytest.approx(r["change"], abs=1e-6)


def test_shares_are_whole(w):
    for gid, share in level.site_totals(w).groupBy("month", "gid").agg(F.sum("share")).select("gid", "sum(share)").collect():
        assert share == pytest.approx(1, abs=1e-4), gid
    for r in category.price_bands(w, [1000.0], ["l2"]).groupBy("l2").agg(F.sum("share").alias("s")).collect():
        assert r["s"] == pytest.approx(1, abs=1e-4)


def test_push_states_part_the_keys(spark, sf, w):
    sales = sales_view(spark, sf)
    cur, prev = base(current_push(sales)), base(previous_push(sales))
    grain = ["month", *SITE, "item"]
    n = {r["status"]: r["n"] for r in arrival.push_diff(cur, prev, grain, ["qty", "amt", "l2"]).groupBy("status").agg(F.sum("keys").alias("n")).collect()}
    assert n["added"] + n["changed"] + n["same"] == cur.count()
    assert n["removed"] + n["changed"] + n["same"] == prev.count()
    recon = governance.item_recon(cur, prev, grain).groupBy("state").count().collect()
    n = {r["state"]: r["count"] for r in recon}
    assert n["new"] + n["open"] == cur.count() and n["resolved"] + n["open"] == prev.count()


def test_fingerprint_sees_doubled_rows(spark, sf):
    t = spark.read.parquet(f"{sf}/part.parquet")
    assert freeze.unchanged(freeze.fingerprint(t), freeze.fingerprint(t.repartition(3)))
    assert not freeze.unchanged(freeze.fingerprint(t), freeze.fingerprint(t.union(t.limit(1))))
    assert not freeze.unchanged(freeze.fingerprint(t), freeze.fingerprint(t.union(t)))


def test_freeze_land_and_load(spark, sf, w, tmp_path):
    w.write.parquet(str(tmp_path / "sales"))
    again = load_sales(spark, str(tmp_path / "sales"))
    assert again.select(w.columns).exceptAll(w).count() == 0
    freeze.land(w, "r", "base", "base(w)", str(tmp_path))
    back = freeze.landed(spark, "r", "base", str(tmp_path))
    assert [r["rows"] for r in freeze.recompute(back, w).collect()] == [0, 0]
    assert sorted(r["rows"] for r in freeze.recompute(back, w.withColumn("qty", F.when(F.col("item") == 1, F.col("qty") + 1).otherwise(F.col("qty")))).collect())[0] > 0


def test_period_change_skips_no_gap(spark):
    rows = [("2001-01-01", 1.0), ("2001-03-01", 2.0), ("2002-01-01", 4.0)]
    df = spark.createDataFrame(rows, "month string, amt double").selectExpr("CAST(month AS DATE) AS month", "CAST(amt AS DECIMAL(20,4)) AS amt", "'x' AS site")
    got = {str(r["month"]): (r["change_1"], r["change_12"]) for r in level.period_change(df, ["site"]).collect()}
    assert got == {"2001-01-01": (None, None), "2001-03-01": (None, None), "2002-01-01": (None, 3.0)}
