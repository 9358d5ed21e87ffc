"""Planted faults: the operator meant for a fault reports it, and only it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline.functions.text import brand_tokens, masked
from plumbline.operators import arrival, brand, coverage, governance, labels, price, screen, tail, tree
from plumbline.sources.sales import SITE

GRAIN = ["month", *SITE, "item"]


@pytest.fixture(scope="module")
def clean(spark):
    """Two sites, twelve months, 40 items in four leaves; steady sales."""
    df = spark.range(2 * 12 * 40).selectExpr(
        "add_months(DATE'2001-01-01', CAST(id DIV 80 AS INT)) AS month",
        "IF(id % 80 < 40, 'JP', 'US') AS country", "'shop' AS platform", "id % 40 AS item",
        "CAST(id % 2 AS INT) AS root", "CAST(id % 2 * 10 + id % 4 AS INT) AS node", "'l1' AS l1",
        "concat('l1/', id % 4) AS l2", "concat('l1/', id % 4) AS leaf", "concat('raw', id % 5) AS raw_brand", "concat('b', id % 5) AS brand",
        "CAST(10 + id % 40 DIV 4 AS DECIMAL(18,2)) AS list_price", "CAST(100 + id % 3 AS DECIMAL(18,2)) AS qty",
    )
    return df.withColumn("amt", (F.col("qty") * F.col("list_price")).cast("decimal(20,4)")).persist()


def _at(df, month="2001-12-01"):
    return F.col("month") == F.lit(month).cast("date")


def test_site_missing(clean):
    lost = clean.where(~(_at(clean) & (F.col("country") == "US")))
    found = arrival.arrival(lost, clean.select(*SITE), clean.select("month")).where("missing").collect()
    assert [(str(r["month"]), r["country"]) for r in found] == [("2001-12-01", "US")]
    assert arrival.arrival(clean, clean.select(*SITE), clean.select("month")).where("missing").count() == 0


def test_doubled_rows(clean):
    twice = clean.union(clean.where(_at(clean) & (F.col("country") == "JP") & (F.col("item") < 2)))
    assert [tuple(r)[:3] for r in arrival.duplicates(twice, GRAIN, "amt").collect()] == [(2, 2, 2)]
    assert arrival.duplicates(clean, GRAIN, "amt").count() == 0


def test_history_rewritten(clean):
    new = clean.withColumn("amt", F.when(_at(clean, "2001-03-01"), F.col("amt") * F.lit(1.3).cast("decimal(2,1)")).otherwise(F.col("amt")).cast("decimal(20,4)"))
    off = arrival.restatement(new, clean, ["month"]).where("ratio <> 1").collect()
    assert [(str(r["month"]), r["ratio"]) for r in off] == [("2001-03-01", 1.3)]
    changed = arrival.push_diff(new, clean, GRAIN, ["amt"]).where("status <> 'same'").collect()
    assert [(str(r["month"]), r["status"], r["keys"]) for r in changed] == [("2001-03-01", "changed", 80)]


def test_coverage_or_estimate(clean):
    fewer = clean.where(~(_at(clean) & (F.col("country") == "US") & (F.col("item") < 16)))
    r = {x["country"]: x for x in coverage.coverage_split(fewer, "2001-12-01", "2001-11-01", SITE).collect()}
    assert r["US"]["lost"] > 100 * abs(r["US"]["matched"]) and r["JP"]["lost"] == 0
    more = clean.withColumn("qty", F.when(_at(clean) & (F.col("country") == "US"), F.col("qty") * 2).otherwise(F.col("qty")).cast("decimal(18,2)"))
    more = more.withColumn("amt", (F.col("qty") * F.col("list_price")).cast("decimal(20,4)"))
    split = {x["country"]: x for x in coverage.volume_price_split(more, "2001-12-01", "2001-11-01", SITE).collect()}
    assert split["US"]["by_volume"] > 10 * abs(split["US"]["by_price"])
    lost = {x["country"]: x["lost"] for x in coverage.coverage_split(more, "2001-12-01", "2001-11-01", SITE).collect()}
    assert lost == {"US": 0.0, "JP": 0.0}


def test_price_slip(clean):
    hit = _at(clean) & (F.col("country") == "JP") & (F.col("item") == 7)
    slip = clean.withColumn("amt", F.when(hit, F.col("amt") * 100).otherwise(F.col("amt")).cast("decimal(20,4)"))
    assert [(r["country"], r["item"], str(r["month"])) for r in price.price_jump(slip).collect()] == [("JP", 7, "2001-12-01")]
    assert price.price_jump(clean).count() == 0
    assert [(r["item"], r["catch_all"]) for r in price.peer_outliers(slip.where(_at(slip)), "l2", 5.0, "/3").collect()] == [(7, True)]
    assert price.peer_outliers(clean.where(_at(clean)), "l2", 5.0).count() == 0


def test_steady_price_surge(clean):
    hit = _at(clean) & (F.col("country") == "JP") & (F.col("item") == 7)
    surge = clean.withColumns({c: F.when(hit, F.col(c) * 20).otherwise(F.col(c)).cast(t) for c, t in (("qty", "decimal(18,2)"), ("amt", "decimal(20,4)"))})
    assert [(r["country"], r["item"]) for r in tail.steady_price_surge(surge).collect()] == [("JP", 7)]
    assert price.price_jump(surge).count() == 0 and tail.steady_price_surge(clean).count() == 0
    top = {r["l2"]: r["top1"] for r in tail.item_concentration(surge.where(_at(surge)), ["l2"]).collect()}
    assert max(top, key=top.get) == "l1/3"


def test_brand_strings(spark):
    rows = [("ソニー(Sony)", "Sony"), ("ソニー(Sony)/SONY株式会社（索尼）", "Sony"), ("ＳＯＮＹ", "Sony"), ("sony", "Sony"), ("ｿﾆｰ", "Sony"), ("ソニー", "Sony"), ("Acme", "Sony"), ("Acme", "Acme"), ("/", "Other"), ("Bose", "Boss"), ("Café", "X"), ("CAFE", "X")]
    names = spark.createDataFrame([(a, b, 1.0) for a, b in rows], "raw_brand string, brand string, amt double")
    got = {r[0]: r[1] for r in names.select("raw_brand", brand_tokens(F.col("raw_brand"))).collect()}
    assert got["ソニー(Sony)/SONY株式会社（索尼）"] == ["ソニー", "Sony", "SONY株式会社", "索尼"] and got["/"] == []
    groups: dict[str, set] = {}
    for r in brand.brand_variants(names).collect():
        groups.setdefault(r["variant"], set()).add(r["spelling"])
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, [{"ＳＯＮＹ", "sony", "Sony"}, {"ソニー", "ｿﾆｰ"}]))
    off = {(r["raw_brand"], r["brand"]) for r in brand.swallowed(names).collect()}
    # the katakana form is known as an alias; one letter apart is near enough
    assert ("Acme", "Sony") in off and ("ソニー", "Sony") not in off and ("Bose", "Boss") not in off and ("Acme", "Acme") not in off
    assert {r["token"] for r in brand.split_brands(names).collect()} == {"acme"}


def test_masks(spark):
    text = "mail a.b@c.org, host 10.1.22.3, call +1 (706) 555-3138, year 2024"
    assert spark.createDataFrame([(text,)], "t string").select(masked(F.col("t"))).first()[0] == "mail <mail>, host <address>, call <number>, year 2024"


def test_rare_root_and_moved_node(clean):
    odd = clean.withColumn("root", F.when((F.col("item") == 8) & _at(clean), 9).otherwise(F.col("root")))
    assert [(r["l2"], r["root"]) for r in tree.rare_roots(odd, "l2", most=0.05).collect()] == [("l1/0", 9)]
    assert tree.rare_roots(clean, "l2", most=0.05).count() == 0


def test_wrong_leaf_in_bulk(spark, clean):
    moved = clean.withColumn("l2", F.when((F.col("l2") == "l1/1") & (F.col("item") < 13), "l1/2").otherwise(F.col("l2")))
    found = labels.label_churn(moved, clean, "item", "l2").collect()
    assert [(r["label_from"], r["label_to"], r["items"]) for r in found] == [("l1/1", "l1/2", 3)]
    sample = spark.createDataFrame([(i, "a" if i < 20 else "b", 1.0, "random" if i % 2 else "random,top") for i in range(40)], "item long, leaf string, amt double, reason string")
    verdict = spark.createDataFrame([(i, "mismatch" if i in (1, 3, 5, 25) else "match" if i % 10 else "unsure") for i in range(40)], "item long, verdict string")
    totals = spark.createDataFrame([("a", 100.0), ("b", 100.0)], "leaf string, total_amt double")
    got = labels.clustered(sample, verdict, totals, ["leaf"]).collect()
    assert [(r["leaf"], r["judged"], r["mismatched"], r["wrong_amt"]) for r in got] == [("a", 18, 3, round(3 / 18 * 82 + 3, 4))]


def test_correction_lost_and_explained_swing(spark, clean):
    wanted = spark.createDataFrame([(1, "l2", "l1/1"), (2, "l2", "l1/3"), (99, "l2", "x")], "item long, field string, wanted string")
    assert {r["item"]: r["state"] for r in governance.carry_over(clean, wanted).collect()} == {1: "kept", 2: "lost", 99: "not applicable"}
    flags = clean.where(_at(clean) & (F.col("item") < 2)).select("month", *SITE, "item")
    told = spark.sql("SELECT 'JP' AS country, CAST(NULL AS STRING) AS platform, DATE'2001-12-01' AS from_month, DATE'2001-12-01' AS to_month")
    got = governance.downgrade(flags, told, SITE).groupBy("country", "state").count().collect()
    assert {(r["country"], r["state"], r["count"]) for r in got} == {("JP", "explained", 2), ("US", "open", 2)}
    assert screen.impact(clean, flags, GRAIN).first()["rows"] == 4


def test_empty_tables(clean):
    none = clean.limit(0)
    assert coverage.coverage_split(none, "2001-12-01", "2001-11-01", SITE).count() == 0
    assert price.price_jump(none).count() == 0 and tail.tail_profile(none, ["l2"]).count() == 0
    assert arrival.restatement(none, none, ["month"]).count() == 0
