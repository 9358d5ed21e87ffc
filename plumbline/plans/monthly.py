"""The monthly run as queries: each operator on the sales view of the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import key_text
from ..functions.numeric import total
from ..operators import arrival as b
from ..operators import brand as h
from ..operators import category as e
from ..operators import coverage as d
from ..operators import freeze as a
from ..operators import governance as k
from ..operators import labels as j
from ..operators import level as c
from ..operators import price as f
from ..operators import screen as m
from ..operators import tail as g
from ..operators import tree as i
from ..sources.sales import SITE, base, both_pushes, current_push, previous_push, previous_rows, sales_view
from ..sources.scratch import shared_folder, written
from . import run

#: The month under review, the month before, and the price bands' edges.
MONTH, BASE_MONTH = "2001-06-01", "2001-05-01"
EDGES = [1000.0, 2000.0, 3000.0, 5000.0]
SCOPE = "country IN ('ASIA', 'EUROPE') AND platform IN ('BUILDING', 'MACHINERY', 'FURNITURE')"
GRAIN = ["month", *SITE, "item"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return add


#: Bases that ``keep`` has persisted, by session, folder and push.
_KEPT: dict[tuple[str, str, str], DataFrame] = {}
_PUSHES = {"all": lambda w: w, "current": current_push, "previous": previous_push}


def _base(spark: SparkSession, sf: str, push: str) -> DataFrame:
    kept = _kept(spark, sf, push)
    return kept if kept is not None else base(_PUSHES[push](sales_view(spark, sf)))


def keep(spark: SparkSession, sf: str) -> None:
    """Build the bases of a folder once and persist them, as a run does; queries of
    this session then start from them. ``drop`` ends that."""
    for push in _PUSHES:
        df = _base(spark, sf, push).persist()
        df.count()
        _KEPT[spark.sparkContext.applicationId, sf, push] = df


def drop(spark: SparkSession, sf: str) -> None:
    for push in _PUSHES:
        if (df := _KEPT.pop((spark.sparkContext.applicationId, sf, push), None)) is not None:
            df.unpersist()


def _w(spark: SparkSession, sf: str) -> DataFrame:
    return _base(spark, sf, "all")


def _cur(spark: SparkSession, sf: str) -> DataFrame:
    return _base(spark, sf, "current")


def _prev(spark: SparkSession, sf: str) -> DataFrame:
    return _base(spark, sf, "previous")


def _kept(spark: SparkSession, sf: str, push: str) -> DataFrame | None:
    return _KEPT.get((spark.sparkContext.applicationId, sf, push))


def _rows(spark: SparkSession, sf: str, push: str) -> DataFrame:
    """What sums of volumes and amounts by any columns start from: a kept base, or else
    the push's own rows, as a base would only be summed again."""
    kept = _kept(spark, sf, push)
    return kept if kept is not None else _PUSHES[push](sales_view(spark, sf))


def _month_amounts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All pushes' amounts by month, site and item, to be summed. Without kept bases the
    source is read once for all: an amount that both pushes have is the same in both."""
    if all(_kept(spark, sf, push) is not None for push in _PUSHES):
        return {push: _rows(spark, sf, push) for push in _PUSHES}
    w = written(sales_view(spark, sf).select("month", *SITE, "item", "amt"), "amounts")
    return {"all": w, "current": current_push(w), "previous": previous_rows(w)}


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _totals(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), total("qty").alias("qty"), total("amt").alias("amt"))


def _names(w: DataFrame) -> DataFrame:
    """Raw and standard brand names with faults in them, per item."""
    items = w.groupBy("item", "raw_brand", "brand", "l1").agg(F.sum("amt").alias("amt"))
    n = F.col("item")
    raw = F.when(n % 3 == 0, F.upper("raw_brand")).when(n % 3 == 1, F.concat("raw_brand", F.lit("("), F.col("l1"), F.lit(")"))).otherwise(F.col("raw_brand"))
    standard = F.when(n % 9 == 0, F.col("brand")).when(n % 9 == 1, F.concat(F.upper("raw_brand"), F.lit("/"), F.col("brand"))).otherwise(F.concat("raw_brand", F.lit("（"), F.col("l1"), F.lit("）")))
    return items.select("item", raw.alias("raw_brand"), standard.alias("brand"), "amt")


@query("A1_load_sales")
def a1(spark, sf):
    return _totals(sales_view(spark, sf), *SITE)


@query("A2_apply_scope")
def a2(spark, sf):
    w = sales_view(spark, sf)
    return _totals(a.apply_scope(w, w.select(*SITE).distinct().where(SCOPE), SITE), "month", *SITE)


@query("A3_freeze")
def a3(spark, sf):
    path = shared_folder(spark, "frozen")
    a.freeze({"standard": _table(spark, sf, "part").select(F.col("p_type").alias("l1"), "p_brand").distinct()}, "run-1", path)
    return a.thaw(spark, "standard", "run-1", path)


@query("A4_merge_rulings")
def a4(spark, sf):
    standard = _w(spark, sf).groupBy("l2").agg(F.min("l1").alias("rule"))
    rulings = standard.where("l2 LIKE '%bolt'").select("l2", F.lit("ruled").alias("rule")).union(standard.where("l2 LIKE '%gear'").select(F.concat("l2", F.lit("-new")), "rule"))
    return a.merge_rulings(standard, rulings, "l2")


@query("A5_land")
def a5(spark, sf):
    path = shared_folder(spark, "landed")
    a.land(c.site_totals(_w(spark, sf)), "run-1", "site_totals", "site_totals(w)", path)
    return a.landed(spark, "run-1", "site_totals", path)


@query("A6_fingerprint")
def a6(spark, sf):
    w = sales_view(spark, sf)
    # the checksum depends on the hash function, so it stays out of the comparison
    return a.fingerprint(w, "month").crossJoin(w.agg(total("amt").alias("amt"))).select("rows", "updated", "amt")


@query("A6_changed_months")
def a6_months(spark, sf):
    w = sales_view(spark, sf)
    other = w.withColumn("qty", F.when((F.col("item") == 100) & (F.col("qty") > 10), F.col("qty") + 1).otherwise(F.col("qty")).cast(w.schema["qty"].dataType))
    # one side as a base keeps it, one from the rows themselves
    return a.changed_months(a.month_checksums(base(w, checks=True)), a.month_checksums(other))


@query("A7_intake")
def a7(spark, sf):
    new = _table(spark, sf, "conversations")
    return a.intake(new, new.where("conv_id % 3 = 0"), ["conv_id"])


@query("A7_mask")
def a7_mask(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return a.intake(docs, docs.where("text NOT RLIKE '[0-9@]'"), ["doc_id"])


@query("B1_arrival")
def b1(spark, sf):
    there = written(b.arrived(sales_view(spark, sf), [*SITE, "l2", "month"]), "arrived")
    return b.arrival_grid(there, there.select(*SITE, "l2"), there.select("month"))


@query("B2_duplicates")
def b2(spark, sf):
    return b.duplicates(_table(spark, sf, "lineitem").withColumn("amt", F.col("l_extendedprice").cast("decimal(18,2)")), ["l_orderkey", "l_linenumber"], "amt")


@query("B3_fill_rate")
def b3(spark, sf):
    w = sales_view(spark, sf).withColumns({"raw_brand": F.when(F.col("item") % 7 != 0, F.col("raw_brand")), "brand": F.when(F.col("item") % 11 == 0, "").otherwise(F.col("brand"))})
    return b.fill_rate(w.select("month", *SITE, "raw_brand", "brand", F.col("list_price").cast("string").alias("list_price")), ["raw_brand", "brand", "list_price"], ["month", *SITE])


@query("B4_push_diff")
def b4(spark, sf):
    return b.push_diff(_cur(spark, sf), _prev(spark, sf), GRAIN, ["qty", "amt", "l2", "brand", "root"])


@query("B4_push_diff_by_tree")
def b4_tree(spark, sf):
    return b.push_diff_by_tree(_cur(spark, sf), _prev(spark, sf), GRAIN, ["qty", "amt", "l2", "brand", "root"])


@query("B4_changed_parts")
def b4_parts(spark, sf):
    # one item of one month and site differs; the hash that deals the parts stays out
    w = _w(spark, sf)
    one = (F.col("item") == 100) & (F.col("qty") > 10)
    other = w.withColumn("qty", F.when(one, F.col("qty") + 1).otherwise(F.col("qty")).cast(w.schema["qty"].dataType))
    trees = [b.push_tree(x, GRAIN, ["qty", "amt"], ["month", *SITE]) for x in (w, other)]
    parts = b.changed_parts(*trees)
    return parts.groupBy("month", *SITE).agg(F.count("*").alias("parts"))


@query("B5_restatement_by_tree")
def b5_tree(spark, sf):
    if _kept(spark, sf, "current") is not None and _kept(spark, sf, "previous") is not None:
        trees = [b.push_tree(x, GRAIN, ["qty", "amt"], ["month"]) for x in (_cur(spark, sf), _prev(spark, sf))]
    else:
        # landed in one pass, from the pushes' own rows: a base would only be summed again
        landed = written(b.push_tree(both_pushes(sales_view(spark, sf)), GRAIN, ["qty", "amt"], ["push", "month"]), "trees")
        trees = [landed.where(F.col("push") == push).drop("push") for push in ("current", "previous")]
    return b.restatement_by_tree(*trees, ["month"])


@query("B5_restatement")
def b5(spark, sf):
    of = _month_amounts(spark, sf)
    return b.restatement(of["current"], of["previous"], ["month"])


@query("C1_site_totals")
def c1(spark, sf):
    return c.site_totals(_w(spark, sf))


@query("C2_period_change")
def c2(spark, sf):
    return c.period_change(_w(spark, sf), SITE)


@query("C3_level_break")
def c3(spark, sf):
    return c.level_break(_w(spark, sf), SITE)


@query("D1_coverage_split")
def d1(spark, sf):
    return d.coverage_split(_w(spark, sf), MONTH, BASE_MONTH, SITE)


@query("D2_count_mean_split")
def d2(spark, sf):
    return d.count_mean_split(_w(spark, sf), MONTH, BASE_MONTH, ["l2"])


@query("D3_volume_price_split")
def d3(spark, sf):
    return d.volume_price_split(_w(spark, sf), MONTH, BASE_MONTH, ["l2"])


@query("E1_category_results")
def e1(spark, sf):
    return e.category_results(_w(spark, sf), ["l1", "l2", "leaf"])


@query("E2_price_bands")
def e2(spark, sf):
    return e.price_bands(_w(spark, sf), EDGES, ["l2"])


@query("E3_band_shift")
def e3(spark, sf):
    return e.band_shift(_w(spark, sf), EDGES, ["l2"], MONTH, BASE_MONTH)


@query("F1_price_summary")
def f1(spark, sf):
    return f.price_summary(_w(spark, sf), ["l2"])


@query("F2_price_jump")
def f2(spark, sf):
    return f.price_jump(_w(spark, sf))


@query("F3_peer_outliers")
def f3(spark, sf):
    w = _w(spark, sf).withColumn("l2", F.when(F.col("l2").endswith("bolt"), F.concat("l2", F.lit("-其他"))).otherwise(F.col("l2")))
    return f.peer_outliers(w, "l2", k=2.0)


@query("G1_tail_profile")
def g1(spark, sf):
    return g.tail_profile(_w(spark, sf), ["l2"], 0.8, 20000.0)


@query("G2_head_turnover")
def g2(spark, sf):
    return g.head_turnover(_w(spark, sf), ["l2"], 5, MONTH, BASE_MONTH)


@query("G3_item_concentration")
def g3(spark, sf):
    return g.item_concentration(_w(spark, sf), ["l2"])


@query("G4_steady_price_surge")
def g4(spark, sf):
    return g.steady_price_surge(_w(spark, sf))


@query("H1_brand_results")
def h1(spark, sf):
    return h.brand_results(_w(spark, sf), ["month", "l1"])


@query("H2_leaf_brand")
def h2(spark, sf):
    return h.leaf_brand(_w(spark, sf))


@query("H3_brand_tokens")
def h3(spark, sf):
    return h.token_amounts(_names(_w(spark, sf)))


@query("H4_brand_variants")
def h4(spark, sf):
    return h.brand_variants(_names(_w(spark, sf)))


@query("H5_swallowed")
def h5(spark, sf):
    return h.swallowed(_names(_w(spark, sf)))


@query("H6_split_brands")
def h6(spark, sf):
    return h.split_brands(_names(_w(spark, sf)))


def _chained(spark, sf):
    """Names in chains: red(red-k), red-k/red-z, red-z; some under an unrelated one."""
    items = _w(spark, sf).groupBy("item", "raw_brand", "brand").agg(F.sum("amt").alias("amt"))
    n, k, z = F.col("item"), F.concat("raw_brand", F.lit("-k")), F.concat("raw_brand", F.lit("-z"))
    raw = F.when(n % 4 == 0, F.concat("raw_brand", F.lit("("), k, F.lit(")"))).when(n % 4 == 1, F.concat(k, F.lit("/"), F.upper(z))).when(n % 4 == 2, z).otherwise(F.col("raw_brand"))
    return items.select("item", raw.alias("raw_brand"), F.when(n % 8 == 3, F.col("brand")).when(n % 8 == 2, F.upper("raw_brand")).otherwise(F.col("raw_brand")).alias("brand"), "amt")


@query("H5_swallowed_families")
def h5_families(spark, sf):
    names = written(_chained(spark, sf), "names")
    return h.swallowed_families(names, h.families(names))


@query("H6_split_families")
def h6_families(spark, sf):
    names = written(_chained(spark, sf), "names")
    return h.split_families(names, h.families(names))


@query("H7_non_brand")
def h7(spark, sf):
    words = spark.createDataFrame([("red",), ("blue",), ("new",)], "word string")
    n = F.col("item")
    names = _w(spark, sf).groupBy("item", "raw_brand").agg(F.sum("amt").alias("amt"))
    return h.non_brand(names.withColumn("raw_brand", F.when(n % 13 == 0, "  ").when(n % 17 == 0, n.cast("string")).otherwise(F.col("raw_brand"))), words)


@query("H8_others_yoy")
def h8(spark, sf):
    return h.others_yoy(_prev(spark, sf), ["l1"])


@query("H9_leaf_top_brands")
def h9(spark, sf):
    return h.leaf_top_brands(_w(spark, sf), "l2", MONTH, BASE_MONTH)


@query("I1_tree_totals")
def i1(spark, sf):
    return i.tree_totals(_w(spark, sf).withColumn("path", F.array(F.col("root").cast("string"), F.col("node").cast("string"))))


@query("I2_tree_diff")
def i2(spark, sf):
    return i.tree_diff(_cur(spark, sf).where("node <> 7"), _prev(spark, sf).where("node <> 12"))


@query("I3_leaf_mix")
def i3(spark, sf):
    return i.leaf_mix(_w(spark, sf), "l2", "root")


@query("I4_rare_roots")
def i4(spark, sf):
    return i.rare_roots(_w(spark, sf), "l2", most=0.05)


@query("I5_leaf_misplaced")
def i5(spark, sf):
    w = _w(spark, sf)
    return i.leaf_misplaced(w, i.leaf_mix(w, "l2", "root").where("share >= 0.1"), "l2", "root")


@query("J1_label_sample")
def j1(spark, sf):
    return j.label_sample(_w(spark, sf), "l2", 5)


def _judged(spark, sf):
    both = _table(spark, sf, "documents").join(_table(spark, sf, "labels"), "doc_id")
    verdict = F.when(F.col("doc_id") % 10 == 0, "unsure").when((F.col("quality") == 0) | (F.col("toxic") == 1), "mismatch").otherwise("match")
    return both.select(F.col("doc_id").alias("item"), "lang", "source", F.col("n_chars").cast("decimal(20,4)").alias("amt"), verdict.alias("verdict"), F.col("doc_id").alias("judged_at"), F.when(F.col("doc_id") % 3 == 0, "top").otherwise("random").alias("reason"))


@query("J2_verdicts")
def j2(spark, sf):
    again = _judged(spark, sf).withColumn("item", F.col("item") % 200)
    return j.verdicts(again)


@query("J3_leaf_mismatch")
def j3(spark, sf):
    judged = _judged(spark, sf)
    return j.leaf_mismatch(judged.select("item", "lang", "source", "amt"), j.verdicts(judged), ["lang", "source"])


@query("J4_clustered")
def j4(spark, sf):
    judged = _judged(spark, sf)
    totals = _table(spark, sf, "documents").groupBy("lang").agg(F.sum("n_chars").cast("double").alias("total_amt"))
    return j.clustered(judged.select("item", "lang", "amt", "reason"), j.verdicts(judged), totals, ["lang"])


@query("J5_unknown_labels")
def j5(spark, sf):
    return j.unknown_labels(_prev(spark, sf), _cur(spark, sf).select("l2"), "l2")


@query("J6_tag_fill")
def j6(spark, sf):
    return j.tag_fill(_table(spark, sf, "events"), ["event_type"], "props")


@query("J7_label_churn")
def j7(spark, sf):
    return j.label_churn(_cur(spark, sf), _prev(spark, sf), "item", "l2")


@query("K1_own_compare")
def k1(spark, sf):
    w = _w(spark, sf).where("brand = 'Brand#4'")
    truth = w.where("item % 19 <> 0").select(*GRAIN, (F.col("qty") * F.col("list_price")).cast("decimal(24,4)").alias("true_amt"))
    return k.own_compare(w.where("item % 13 <> 0"), truth, GRAIN, ["country"])


@query("K2_carry_over")
def k2(spark, sf):
    w = _w(spark, sf)
    fixes = w.where("item % 10 = 0").select("item", F.lit("l2").alias("field"), F.when(F.col("item") % 20 == 0, F.col("l2")).otherwise(F.concat("l2", F.lit("/fixed"))).alias("wanted")).distinct()
    return k.carry_over(w.where("item % 30 <> 0"), fixes)


@query("K3_release_compare")
def k3(spark, sf):
    return k.release_compare(_rows(spark, sf, "current"), _rows(spark, sf, "previous"), ["l1", *SITE])


_DEFECTS = [(1, "ASIA", None, None, "amt", 60000.0), (2, None, "BUILDING", "SMALL/bolt", "qty", 60.0), (3, "EUROPE", "FURNITURE", None, "qty", 1.0), (4, "NOWHERE", None, None, "amt", 1.0)]


def _defects(spark):
    return spark.createDataFrame(_DEFECTS, "id int, country string, platform string, l2 string, measure string, bound double")


@query("K4_recheck")
def k4(spark, sf):
    return k.recheck(_w(spark, sf), _defects(spark), [*SITE, "l2"])


@query("K5_promises")
def k5(spark, sf):
    ledger = spark.sql("SELECT id, CAST(d AS DATE) AS promised_by FROM VALUES (1, '2001-05-01'), (2, '2001-08-01'), (3, '2001-06-01'), (4, '2001-04-01') AS v(id, d)")
    return k.promises(ledger, k.recheck(_w(spark, sf), _defects(spark), [*SITE, "l2"]), MONTH)


def _flags(spark, sf):
    """Items whose price jumped, with their month."""
    return f.price_jump(_w(spark, sf), 1.8)


@query("K6_item_recon")
def k6(spark, sf):
    flags = _flags(spark, sf)
    at = lambda x: flags.where(F.col("month") == F.lit(x).cast("date"))
    return k.item_recon(at(MONTH), at(BASE_MONTH), [*SITE, "item"])


@query("K7_downgrade")
def k7(spark, sf):
    told = spark.sql("SELECT country, platform, CAST(f AS DATE) AS from_month, CAST(t AS DATE) AS to_month FROM VALUES ('ASIA', 'BUILDING', '1996-01-01', '1998-12-01'), (CAST(NULL AS STRING), 'FURNITURE', '2000-01-01', '2000-06-01'), ('EUROPE', CAST(NULL AS STRING), '1997-03-01', '1997-03-01') AS v(country, platform, f, t)")
    return k.downgrade(_flags(spark, sf), told, SITE)


@query("K8_flag_history")
def k8(spark, sf):
    flags = _flags(spark, sf)
    now = F.lit(MONTH).cast("date")
    return k.flag_history(flags.where(F.col("month") == now), flags.where(F.col("month") < now), ["item"])


_RULES = [("change_1", -0.9, 2.0, "month-on-month", 2), ("change_12", -0.9, 3.0, "year-on-year", 1), ("ratio", 0.95, 1.05, "restated", 3)]


def _rules(spark):
    return spark.createDataFrame(_RULES, "metric string, low double, high double, rule string, severity int")


def _changes(df):
    return m.long_results(c.period_change(df, SITE), "level", ["month", *SITE], ["change_1", "change_12"])


def _screened(spark, sf):
    of = _month_amounts(spark, sf)
    restated = m.long_results(b.restatement(of["current"], of["previous"], ["month", *SITE]), "restated", ["month", *SITE], ["ratio"])
    return m.screen(_changes(of["all"]).unionByName(restated), _rules(spark))


@query("M1_screen")
def m1(spark, sf):
    return _screened(spark, sf)


def _amounts(spark, sf):
    return _rows(spark, sf, "all").groupBy("month", *SITE).agg(F.sum("amt").alias("amt")).groupBy(key_text("month", *SITE).alias("key")).agg(F.sum("amt").alias("amt"))


@query("M2_digest")
def m2(spark, sf):
    return m.digest(_screened(spark, sf).join(_amounts(spark, sf), "key"), 5)


@query("M3_impact")
def m3(spark, sf):
    w = _w(spark, sf)
    return m.impact(w, f.price_jump(w, 1.8), GRAIN)


def _grained(spark, sf):
    """All rows, and flags of three grains about them: months and sites, leaves of a
    site, items. Without a kept base one is written, as each kind of flags is made of it
    and all of them are looked up for it."""
    w = dealt = _kept(spark, sf, "all")
    if w is None:
        w = written(_w(spark, sf).select(*GRAIN, "l2", "root", "qty", "amt"), "base")
        dealt = w.repartition("item")  # once for an item's months and for their order
    flags = (
        m.screen(_changes(w), _rules(spark)).select("module", "key")
        .unionByName(i.rare_roots(w, "l2", most=0.03).select(F.lit("tree").alias("module"), key_text("l2", "root").alias("key")))
        .unionByName(f.price_jump(dealt, 1.8).select(F.lit("price").alias("module"), key_text("month", *SITE, "item").alias("key")))
    )
    return w, flags


@query("M3_impact_of_grains")
def m3_grains(spark, sf):
    return m.impact_of_grains(*_grained(spark, sf), SITE)


@query("M3_module_impact")
def m3_modules(spark, sf):
    return m.module_impact(*_grained(spark, sf), SITE).withColumn("amt", F.col("amt").cast("double"))


@query("M4_drill_flags")
def m4_flags(spark, sf):
    return m.drill_flags(_w(spark, sf), _screened(spark, sf), MONTH, n=5)


@query("M4_drill")
def m4(spark, sf):
    return m.drill(_w(spark, sf), {"country": "ASIA", "platform": "BUILDING"}, MONTH, BASE_MONTH, 20)


@query("M5_recompute")
def m5(spark, sf):
    path = shared_folder(spark, "landed")
    again = c.site_totals(_w(spark, sf))
    a.land(again, "run-1", "site_totals", "site_totals(w)", path)
    changed = again.withColumn("items", F.col("items") + F.when((F.col("gid") == 3) & (F.col("month") == F.lit(MONTH).cast("date")), 1).otherwise(0))
    return a.recompute(a.landed(spark, "run-1", "site_totals", path), changed)


@query("M5_recompute_view")
def m5_view(spark, sf):
    w, path = sales_view(spark, sf), shared_folder(spark, "run")
    told = spark.createDataFrame([], "country string, platform string, from_month date, to_month date")
    run.freeze_inputs(current_push(w), previous_push(w), None, told, "run-1", path)
    run.land_views(spark, "run-1", run.parameters(MONTH, BASE_MONTH), path, ["push_diff"])
    # nothing but the run and the view is told
    return run.recompute(spark, "run-1", "push_diff", path)


@query("A5_landed_view")
def a5_view(spark, sf):
    w, path = sales_view(spark, sf), shared_folder(spark, "run")
    told = spark.createDataFrame([], "country string, platform string, from_month date, to_month date")
    run.freeze_inputs(current_push(w), previous_push(w), None, told, "run-1", path)
    run.land_views(spark, "run-1", run.parameters(MONTH, BASE_MONTH), path, ["period_change"])
    return a.landed(spark, "run-1", "period_change", path).where(F.col("month") == F.lit(MONTH).cast("date"))


@query("M6_acceptance")
def m6(spark, sf):
    flags = _flags(spark, sf)
    told = spark.sql("SELECT 'ASIA' AS country, CAST(NULL AS STRING) AS platform, DATE'2001-01-01' AS from_month, DATE'2001-12-01' AS to_month")
    price = k.downgrade(flags, told, SITE).select(F.lit("price").alias("module"), *SITE, "state", F.col("amt").cast("decimal(24,4)").alias("amt"))
    breaks = c.level_break(_w(spark, sf), SITE).select(F.lit("level").alias("module"), *SITE, F.lit("open").alias("state"), F.col("value").cast("decimal(24,4)").alias("amt"))
    return m.acceptance(price.unionByName(breaks), _w(spark, sf).groupBy(*SITE).agg(F.sum("amt").alias("total_amt")), SITE)
