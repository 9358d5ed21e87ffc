"""Keys of flags: nulls, grains, what they are about, and the items behind them."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from plumbline.functions import keys
from plumbline.operators import arrival, labels, price, screen, tree
from plumbline.plans import monthly
from plumbline.plans.monthly import QUERIES
from plumbline.plans.oracle import ORACLE
from plumbline.sources.sales import base, sales_view

JUNE, MAY = datetime.date(2001, 6, 1), datetime.date(2001, 5, 1)
SITE = ["country", "platform"]


@pytest.fixture(scope="module")
def df(spark):
    rows = [(m, c, p, leaf, i, 10 * i + (m == JUNE) * i * i if i else None) for m in (MAY, JUNE) for c, p in (("X", None), (None, "X"), ("A", "P"), (None, None)) for leaf in ("x", None) for i in (1, 2, None) if i or leaf]
    return spark.createDataFrame(rows, "month date, country string, platform string, leaf string, item long, a int").select("*", F.coalesce("a", F.lit(7)).cast("decimal(20,4)").alias("amt")).drop("a").persist()


def test_keys_with_nulls_are_told_apart(df):
    long = screen.long_results(df.groupBy("country", "platform").agg(F.count("*").alias("n")), "level", SITE, ["n"])
    assert {r["key"] for r in long.collect()} == {'{"country":"X","platform":null}', '{"country":null,"platform":"X"}', '{"country":"A","platform":"P"}', '{"country":null,"platform":null}'}


def _flags(spark, *rows):
    return spark.createDataFrame(list(rows), "module string, key string, state string")


def test_impact_counts_a_row_once(spark, df):
    flags = _flags(
        spark, ("level", '{"country":null,"platform":"X"}', "open"), ("price", '{"country":null,"platform":"X","item":1}', "open"),
        ("price", '{"leaf":null,"item":2}', "open"), ("level", '{"item":null}', "explained"), ("level", '{"item":null}', "open"),
    )
    assert [n for n, _ in keys.least_cover(flags, df)] == [["item"], ["country", "platform"], ["item", "leaf"], ["country", "item", "platform"]]
    # the item of a flagged site is held by the site's flag
    assert keys.least_cover(flags, df)[3][1].count() == 0
    about = lambda r: (r["country"] is None and r["platform"] == "X") or (r["leaf"] is None and r["item"] == 2) or r["item"] is None
    rows = df.collect()
    for r in screen.impact_of_grains(df, flags, SITE).collect():
        mine = [x for x in rows if (x["country"], x["platform"]) == (r["country"], r["platform"])]
        assert (r["rows"], r["touched"]) == (sum(map(about, mine)), float(sum(x["amt"] for x in mine if about(x))))
    got = {(r["module"], r["country"], r["platform"]): r["rows"] for r in screen.module_impact(df, flags, SITE).collect()}
    assert got["level", None, "X"] == sum(r["platform"] == "X" and r["country"] is None for r in rows)
    assert got["price", "A", "P"] == sum(r["country"] == "A" and r["leaf"] is None and r["item"] == 2 for r in rows)
    none = screen.impact_of_grains(df, flags.where("false"), SITE).collect()
    assert len(none) == 4 and {r["rows"] for r in none} == {0}


def test_impact_of_grains_is_told_of_every_price_jump(spark, sf):
    w = base(sales_view(spark, sf)).persist()
    held = lambda d, *names: {tuple(r[n] for n in names) for r in d.collect()}
    level = {r["key"] for r in QUERIES["M1_screen"](spark, sf).where("module = 'level'").collect()}
    rare, jumps = held(tree.rare_roots(w, "l2", most=0.03), "l2", "root"), held(price.price_jump(w, 1.8), *monthly.GRAIN)
    want = dict.fromkeys(held(w, *SITE), 0)
    for r in w.select(*monthly.GRAIN, "l2", "root", keys.key_text("month", *SITE).alias("key")).collect():
        want[r["country"], r["platform"]] += r["key"] in level or (r["l2"], r["root"]) in rare or tuple(r[n] for n in monthly.GRAIN) in jumps
    w.unpersist()
    assert {(r["country"], r["platform"]): r["rows"] for r in QUERIES["M3_impact_of_grains"](spark, sf).collect()} == want


def test_module_impact_counts_every_price_jump(spark, sf, duck):
    every = QUERIES["M3_impact"](spark, sf).first()["rows"]
    assert sum(r["rows"] for r in QUERIES["M3_module_impact"](spark, sf).where("module = 'price'").collect()) == every
    assert duck.execute(f"SELECT sum(rows) FROM ({ORACLE['M3_module_impact']}) WHERE module = 'price'").fetchone()[0] == every


def test_every_flag_is_drilled_in_one_go(spark, df):
    flags = _flags(spark, ("level", '{"month":"2001-06-01","country":null,"platform":"X"}', "open"), ("price", '{"leaf":null}', "open"), ("price", '{"leaf":null}', "explained"))
    got = {(r["key"], r["rank"]): (r["item"], r["change"]) for r in screen.drill_flags(df, flags, "2001-06-01", n=2).collect()}
    site = screen.drill(df, {"country": None, "platform": "X"}, "2001-06-01", "2001-05-01", 2).collect()
    leaf = screen.drill(df, {"leaf": None}, "2001-06-01", "2001-05-01", 2).collect()
    assert {k: v for k, v in got.items() if "month" in k[0]} == {('{"month":"2001-06-01","country":null,"platform":"X"}', i + 1): (r["item"], r["change"]) for i, r in enumerate(site)}
    assert {k: v for k, v in got.items() if "month" not in k[0]} == {('{"leaf":null}', i + 1): (r["item"], r["change"]) for i, r in enumerate(leaf)}
    assert len(site) == 2 and site[0]["item"] == 2
    assert screen.drill_flags(df, flags.where("false"), "2001-06-01").count() == 0


def test_acceptance_with_null_sites(spark, df):
    flags = df.where("platform IS NULL").select(F.lit("m").alias("module"), *SITE, F.lit("open").alias("state"), F.col("amt").cast("decimal(24,4)").alias("amt"))
    totals = df.groupBy(*SITE).agg(F.sum("amt").alias("total_amt"))
    got = {(r["country"], r["platform"]): r["status"] for r in screen.acceptance(flags, totals, SITE).collect()}
    assert got == {("X", None): "fail", (None, None): "fail", (None, "X"): "pass", ("A", "P"): "pass"}
    assert [r["rows"] for r in screen.impact(df, flags, SITE).collect()] == [df.where("platform IS NULL").count()]
    out = screen.module_acceptance(df, _flags(spark, ("m", '{"platform":null}', "explained"), ("m", '{"item":1}', "open")), SITE, ["m", "n", "o"], ["o"]).collect()
    assert {(r["module"], r["status"], r["flags"]) for r in out} == {("m", "fail", 2), ("m", "fail", 1), ("n", "pass", 0), ("o", "not checked", 0)}


def test_churn_from_and_to_no_label(spark):
    side = lambda *rows: spark.createDataFrame(list(rows), "item long, l2 string, amt decimal(20,4)")
    from decimal import Decimal as D

    cur, prev = side((1, None, D(5)), (2, "a", D(6)), (None, "b", D(7)), (3, None, D(8))), side((1, "a", D(1)), (2, None, D(1)), (None, "a", D(1)), (3, None, D(1)))
    assert {(r["label_from"], r["label_to"]): r["amt"] for r in labels.label_churn(cur, prev, "item", "l2").collect()} == {("a", None): 5.0, (None, "a"): 6.0, ("a", "b"): 7.0}


def test_only_parts_that_differ_are_joined(spark, df):
    key, measures = ["month", *SITE, "leaf", "item"], ["amt"]
    other = df.withColumn("amt", F.when((F.col("country") == "A") & (F.col("item") == 2) & F.col("leaf").isNull() & (F.col("month") == F.lit(JUNE)), F.lit(1)).otherwise(F.col("amt")).cast("decimal(20,4)"))
    trees = [arrival.push_tree(d, key, measures, ["month", *SITE]) for d in (df, other)]
    parts = arrival.changed_parts(*trees)
    assert [tuple(r)[:3] for r in parts.collect()] == [(JUNE, "A", "P")]
    assert arrival.only_parts(df, parts, key).count() < 3
    for a, b in ((df, other), (df, df), (df, df.where("item = 1")), (df.where("false"), df)):
        plain, tree = (sorted(map(repr, f(a, b, key, measures).collect())) for f in (arrival.push_diff, arrival.push_diff_by_tree))
        assert plain == tree
    same = lambda d: sorted(map(repr, d.collect()))
    assert same(arrival.restatement_by_tree(*trees, ["month"])) == same(arrival.restatement(df, other, ["month"]))
