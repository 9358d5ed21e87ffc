"""The views of a monthly run: what each is made of, so that it can be made again.

A view is a function of named tables (frozen inputs or other landed views) and of the
run's parameters. The catalog keeps its name, its tables and the parameters; that is
all that ``run.recompute`` needs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import key_text
from ..operators import arrival, brand, category, coverage, governance, labels, level, price, screen, tail, tree
from ..sources.sales import SITE

GRAIN = ["month", *SITE, "item"]

#: The modules that every run has, in order.
MODULES = ["arrival", "level", "coverage", "category", "price", "tail", "brand", "tree", "labels", "own", "carry", "defects"]

#: What a run can be given besides the two pushes. One that it isn't given is empty, and
#: a module that needs it isn't checked.
INPUTS = {
    "standard": "label string",
    "verdicts": "item long, verdict string, judged_at long, reason string",
    "truth": "month date, country string, platform string, item long, true_amt decimal(24,4)",
    "corrections": "item long, field string, wanted string",
    "defects": "id int, country string, platform string, leaf string, measure string, bound double",
    "ledger": "id int, promised_by date",
    "words": "word string",
    "accepted": "label string, root int",
}

#: The inputs without which a module says nothing. The others of the module then do.
NEEDED = {"labels": ["verdicts"], "own": ["truth"], "carry": ["corrections"], "defects": ["defects"]}

#: Bounds of the first screening: a value outside of them is a flag.
RULES = [
    ("missing", None, 0.0, "site missing", 3), ("filled", 0.5, None, "field mostly empty", 2), ("ratio", 0.95, 1.05, "restated", 3),
    ("change_1", -0.9, 2.0, "month-on-month", 2), ("change_12", -0.9, 3.0, "year-on-year", 1), ("break", None, 0.0, "level break", 2),
    ("coverage_part", None, 0.9, "change by coverage", 1), ("shift", None, 0.9, "price bands moved", 1), ("moved", 1 / 1.8, 1.8, "price jump", 2), ("times", 0.2, 5.0, "far from peers", 1),
    ("top1", None, 0.95, "one item is the leaf", 1), ("volume_times", None, 5.0, "volume surge", 2), ("swallowed", None, 0.0, "unrelated raw brand", 2), ("standards", None, 2.0, "brand in several names", 1),
    ("non_brand", None, 0.0, "no brand name", 1), ("others_change", -0.2, 0.2, "OTHERS moved", 1), ("rare", None, 0.0, "rare root", 1), ("node", None, 0.0, "node moved", 2), ("misplaced", None, 0.5, "leaf misplaced", 2),
    ("unknown", None, 0.0, "label not in the standard", 3), ("churned", None, 0.0, "labels changed", 1), ("mismatch", None, 0.1, "mismatches cluster", 3), ("own_error", None, 0.2, "far from true sales", 3),
    ("correction_lost", None, 0.0, "correction lost", 3), ("release_ratio", 0.9, 1.1, "far from the release", 2), ("defect", None, 0.0, "known defect", 3), ("promise", None, 0.0, "promise broken", 3),
]
RULE_SCHEMA = "metric string, low double, high double, rule string, severity int"

Tables = Callable[[str], DataFrame]


@dataclass(frozen=True)
class View:
    module: str
    #: Frozen inputs and views that it is made of.
    needs: tuple[str, ...]
    make: Callable[[Tables, dict], DataFrame]


VIEWS: dict[str, View] = {}


def view(module: str, *needs: str) -> Callable:
    def add(make: Callable[[Tables, dict], DataFrame]) -> Callable[[Tables, dict], DataFrame]:
        VIEWS[make.__name__] = View(module, needs, make)
        return make

    return add


def resolve(name: str) -> View:
    if name not in VIEWS:
        raise KeyError(f"no view {name!r}")
    return VIEWS[name]


def _in(df: DataFrame, p: dict) -> DataFrame:
    """The month under review."""
    return df.where(F.col("month") == F.lit(p["month"]).cast("date"))


def _by_site(p: dict) -> list[str]:
    return [*SITE, p["leaf"]]


def _label(df: DataFrame, p: dict) -> DataFrame:
    return df.withColumnRenamed("label", p["leaf"])


# arrival and completeness


@view("arrival", "now")
def arrival_grid(t: Tables, p: dict) -> DataFrame:
    return arrival.arrival(t("now"), t("now").select(*SITE), t("now").select("month"))


@view("arrival", "now")
def duplicates(t: Tables, p: dict) -> DataFrame:
    return arrival.duplicates(t("now"), GRAIN, "amt")


@view("arrival", "now")
def fill_rate(t: Tables, p: dict) -> DataFrame:
    return arrival.fill_rate(t("now"), ["raw_brand", "brand", p["leaf"], "root"], ["month", *SITE])


def tree_key(p: dict) -> tuple[list[str], list[str]]:
    """What the pushes' checksum trees are of: key and measures."""
    return GRAIN, ["qty", "amt", p["leaf"], "brand"]


@view("arrival", "now")
def push_tree(t: Tables, p: dict) -> DataFrame:
    return arrival.push_tree(t("now"), *tree_key(p), ["month", *SITE])


@view("arrival", "now", "then", "push_tree")
def push_diff(t: Tables, p: dict) -> DataFrame:
    last = arrival.push_tree(t("then"), *tree_key(p), ["month", *SITE])
    return arrival.push_diff_by_tree(t("now"), t("then"), *tree_key(p), by=["month", *SITE], trees=(t("push_tree"), last))


@view("arrival", "now", "then")
def restatement(t: Tables, p: dict) -> DataFrame:
    return arrival.restatement(t("now"), t("then"), ["month", *SITE])


# site level


@view("level", "now")
def site_totals(t: Tables, p: dict) -> DataFrame:
    return level.site_totals(t("now"))


@view("level", "now")
def period_change(t: Tables, p: dict) -> DataFrame:
    return level.period_change(t("now"), SITE)


@view("level", "now")
def level_break(t: Tables, p: dict) -> DataFrame:
    return level.level_break(t("now"), SITE)


# coverage or estimate


@view("coverage", "now")
def coverage_split(t: Tables, p: dict) -> DataFrame:
    return coverage.coverage_split(t("now"), p["month"], p["base_month"], _by_site(p))


@view("coverage", "now")
def count_mean_split(t: Tables, p: dict) -> DataFrame:
    return coverage.count_mean_split(t("now"), p["month"], p["base_month"], _by_site(p))


@view("coverage", "now")
def volume_price_split(t: Tables, p: dict) -> DataFrame:
    return coverage.volume_price_split(t("now"), p["month"], p["base_month"], _by_site(p))


# standard category


@view("category", "now")
def category_results(t: Tables, p: dict) -> DataFrame:
    return category.category_results(_in(t("now"), p), [*SITE, "l1", p["leaf"]])


@view("category", "now")
def price_bands(t: Tables, p: dict) -> DataFrame:
    return category.price_bands(_in(t("now"), p), p["edges"], _by_site(p))


@view("category", "now")
def band_shift(t: Tables, p: dict) -> DataFrame:
    return category.band_shift(t("now"), p["edges"], _by_site(p), p["month"], p["base_month"])


# price; leaf views are by site, and those of catch-all leaves apart


@view("price", "now")
def price_summary(t: Tables, p: dict) -> DataFrame:
    return price.price_summary(_in(t("now"), p), _by_site(p))


@view("price", "now")
def price_jump(t: Tables, p: dict) -> DataFrame:
    return price.price_jump(t("now"))


@view("price", "now")
def outliers(t: Tables, p: dict) -> DataFrame:
    return price.leaf_outliers(_in(t("now"), p), p["leaf"], by=SITE)[0]


@view("price", "now")
def catch_all_outliers(t: Tables, p: dict) -> DataFrame:
    return price.leaf_outliers(_in(t("now"), p), p["leaf"], by=SITE)[1]


# head and long tail


@view("tail", "now")
def tail_profile(t: Tables, p: dict) -> DataFrame:
    return tail.tail_profile(_in(t("now"), p), _by_site(p))


@view("tail", "now")
def head_turnover(t: Tables, p: dict) -> DataFrame:
    return tail.head_turnover(t("now"), _by_site(p), 10, p["month"], p["base_month"])


@view("tail", "now")
def concentration(t: Tables, p: dict) -> DataFrame:
    return tail.item_concentration(_in(t("now"), p), _by_site(p))


@view("tail", "now")
def surge(t: Tables, p: dict) -> DataFrame:
    return tail.steady_price_surge(t("now"))


# brand layer


@view("brand", "now")
def brand_results(t: Tables, p: dict) -> DataFrame:
    return brand.brand_results(_in(t("now"), p), _by_site(p))


@view("brand", "now")
def leaf_brand(t: Tables, p: dict) -> DataFrame:
    return brand.leaf_brand(_in(t("now"), p))


@view("brand", "now")
def brand_names(t: Tables, p: dict) -> DataFrame:
    return _in(t("now"), p).groupBy("item", "raw_brand", "brand").agg(F.sum("amt").alias("amt"))


@view("brand", "brand_names")
def brand_tokens(t: Tables, p: dict) -> DataFrame:
    return brand.token_amounts(t("brand_names"))


@view("brand", "brand_names")
def brand_variants(t: Tables, p: dict) -> DataFrame:
    return brand.brand_variants(t("brand_names"))


@view("brand", "brand_names")
def swallowed(t: Tables, p: dict) -> DataFrame:
    return brand.swallowed(t("brand_names"))


@view("brand", "brand_names")
def split_brands(t: Tables, p: dict) -> DataFrame:
    return brand.split_brands(t("brand_names"))


@view("brand", "brand_names", "words")
def non_brand(t: Tables, p: dict) -> DataFrame:
    return brand.non_brand(t("brand_names"), t("words"))


@view("brand", "now")
def others_yoy(t: Tables, p: dict) -> DataFrame:
    return brand.others_yoy(t("now"), [*SITE, "l1"])


@view("brand", "now")
def top_brands(t: Tables, p: dict) -> DataFrame:
    return brand.leaf_top_brands(t("now"), p["leaf"], p["month"], p["base_month"])


# platform category tree


@view("tree", "now")
def tree_totals(t: Tables, p: dict) -> DataFrame:
    return tree.tree_totals(_in(t("now"), p).withColumn("path", F.array(F.col("root").cast("string"), F.col("node").cast("string"))))


@view("tree", "now", "then")
def tree_diff(t: Tables, p: dict) -> DataFrame:
    return tree.tree_diff(t("now"), t("then"))


@view("tree", "now")
def leaf_mix(t: Tables, p: dict) -> DataFrame:
    return tree.leaf_mix(_in(t("now"), p), p["leaf"], "node", by=SITE)


@view("tree", "now")
def rare_roots(t: Tables, p: dict) -> DataFrame:
    return tree.rare_roots(_in(t("now"), p), p["leaf"])


@view("tree", "now", "accepted")
def leaf_misplaced(t: Tables, p: dict) -> DataFrame:
    """Outside the accepted roots, or, without a list, outside those of a tenth of the
    leaf over all months."""
    usual = tree.leaf_mix(t("now"), p["leaf"], "root").where("share >= 0.1").select(p["leaf"], "root")
    listed = _label(t("accepted"), p)
    return tree.leaf_misplaced(_in(t("now"), p), usual if "accepted" in p["absent"] else listed, p["leaf"], "root")


# label quality


@view("labels", "now")
def label_sample(t: Tables, p: dict) -> DataFrame:
    return labels.label_sample(_in(t("now"), p), p["leaf"], p["sample"])


@view("labels", "now", "verdicts")
def leaf_mismatch(t: Tables, p: dict) -> DataFrame:
    items = _in(t("now"), p).groupBy("item", p["leaf"]).agg(F.sum("amt").alias("amt"))
    return labels.leaf_mismatch(items, labels.verdicts(t("verdicts")), [p["leaf"]])


@view("labels", "now", "verdicts")
def clustered(t: Tables, p: dict) -> DataFrame:
    items = _in(t("now"), p).groupBy("item", p["leaf"]).agg(F.sum("amt").alias("amt"))
    why = t("verdicts").groupBy("item").agg(F.array_join(F.sort_array(F.collect_set("reason")), ",").alias("reason"))
    totals = items.groupBy(p["leaf"]).agg(F.sum("amt").cast("double").alias("total_amt"))
    return labels.clustered(items.join(why, "item"), labels.verdicts(t("verdicts")), totals, [p["leaf"]])


@view("labels", "now", "then", "standard")
def unknown_labels(t: Tables, p: dict) -> DataFrame:
    """Against the frozen standard, or, without one, the last push's labels."""
    known = t("then").select(p["leaf"]) if "standard" in p["absent"] else _label(t("standard"), p)
    return labels.unknown_labels(_in(t("now"), p), known, p["leaf"])


@view("labels", "now", "then")
def label_churn(t: Tables, p: dict) -> DataFrame:
    return labels.label_churn(_in(t("now"), p), _in(t("then"), p), "item", p["leaf"])


# own products, corrections, the release, known defects


@view("own", "now", "truth")
def own_compare(t: Tables, p: dict) -> DataFrame:
    own = _in(t("now"), p).join(t("truth").select("item").distinct(), "item", "left_semi")
    return governance.own_compare(own, _in(t("truth"), p), GRAIN, SITE)


@view("carry", "now", "corrections")
def carry_over(t: Tables, p: dict) -> DataFrame:
    return governance.carry_over(_in(t("now"), p), t("corrections"))


@view("carry", "now", "then")
def release_compare(t: Tables, p: dict) -> DataFrame:
    return governance.release_compare(_in(t("now"), p), _in(t("then"), p), SITE)


@view("defects", "now", "defects")
def recheck(t: Tables, p: dict) -> DataFrame:
    return governance.recheck(_in(t("now"), p), _label(t("defects").withColumnRenamed("leaf", "label"), p), _by_site(p))


@view("defects", "recheck", "ledger")
def promises(t: Tables, p: dict) -> DataFrame:
    return governance.promises(t("ledger"), t("recheck"), p["month"])


# flags, their history and the acceptance

_FLAGGED = (
    "arrival_grid", "fill_rate", "restatement", "period_change", "level_break", "coverage_split", "band_shift", "price_jump", "outliers", "concentration", "surge",
    "swallowed", "split_brands", "non_brand", "others_yoy", "rare_roots", "tree_diff", "leaf_misplaced", "unknown_labels", "label_churn", "clustered",
    "own_compare", "carry_over", "release_compare", "recheck", "promises",
)


def measured(t: Tables, p: dict) -> DataFrame:
    """The views' results as rows of module, key, metric and value, in the month under
    review. Each is keyed by the columns that it is about."""
    leaf, one = p["leaf"], F.lit(1.0)
    month = F.lit(p["month"]).cast("date")
    # entries of the ledger are about what they name; a null scope is any
    scope = t("defects").select("id", F.to_json(F.struct(F.col("country"), F.col("platform"), F.col("leaf").alias(leaf))).alias("key"))
    still = t("recheck").where("state = 'still present'").join(scope, "id")
    broken = t("promises").where("promise = 'broken'").join(scope, "id")
    # (view, its rows, columns of the key, metric: value)
    told = [
        ("arrival_grid", _in(t("arrival_grid"), p), ["month", *SITE], {"missing": F.col("missing").cast("double")}),
        ("fill_rate", _in(t("fill_rate"), p), ["month", *SITE], {"filled": F.col("filled")}),
        ("restatement", t("restatement"), ["month", *SITE], {"ratio": F.col("ratio")}),
        ("period_change", _in(t("period_change"), p), ["month", *SITE], {"change_1": F.col("change_1"), "change_12": F.col("change_12")}),
        ("level_break", _in(t("level_break"), p), ["month", *SITE], {"break": one}),
        ("coverage_split", t("coverage_split").where("abs(added - lost) + abs(matched) > 0"), _by_site(p), {"coverage_part": F.abs(F.col("added") - F.col("lost")) / (F.abs(F.col("added") - F.col("lost")) + F.abs("matched"))}),
        ("band_shift", t("band_shift"), _by_site(p), {"shift": F.col("shift")}),
        ("price_jump", _in(t("price_jump"), p), GRAIN, {"moved": F.col("moved")}),
        ("outliers", t("outliers"), [*_by_site(p), "item"], {"times": F.col("times")}),
        ("concentration", t("concentration").where("items > 1"), _by_site(p), {"top1": F.col("top1")}),
        ("surge", _in(t("surge"), p), GRAIN, {"volume_times": F.col("volume_times")}),
        ("swallowed", t("swallowed"), ["raw_brand", "brand"], {"swallowed": one}),
        ("split_brands", t("split_brands").withColumnRenamed("standard", "brand"), ["brand"], {"standards": F.col("standards").cast("double")}),
        ("non_brand", t("non_brand").withColumnRenamed("name", "raw_brand"), ["raw_brand"], {"non_brand": one}),
        ("others_yoy", _in(t("others_yoy"), p), [*SITE, "l1"], {"others_change": F.col("change")}),
        ("rare_roots", t("rare_roots"), [leaf, "root"], {"rare": one}),
        ("tree_diff", t("tree_diff"), ["node"], {"node": one}),
        ("leaf_misplaced", t("leaf_misplaced"), [leaf], {"misplaced": F.col("share")}),
        ("unknown_labels", t("unknown_labels"), [leaf], {"unknown": one}),
        ("label_churn", t("label_churn").withColumnRenamed("label_to", leaf), [leaf], {"churned": F.col("items").cast("double")}),
        ("clustered", t("clustered"), [leaf], {"mismatch": F.col("mismatched") / F.col("judged")}),
        ("own_compare", t("own_compare"), SITE, {"own_error": F.col("p90")}),
        ("carry_over", t("carry_over").where("state = 'lost'"), ["item"], {"correction_lost": one}),
        ("release_compare", t("release_compare"), SITE, {"release_ratio": F.col("ratio")}),
        ("recheck", still, None, {"defect": one}),
        ("promises", broken, None, {"promise": one}),
    ]
    rows = None
    for name, df, key, metrics in told:
        about = F.col("key") if key is None else key_text(*key)
        values = F.array(*(F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in metrics.items()))
        part = df.select(F.lit(VIEWS[name].module).alias("module"), F.lit(name).alias("view"), about.alias("key"), F.explode(values).alias("_m")).select("module", "view", "key", "_m.metric", "_m.value")
        rows = part if rows is None else rows.unionByName(part)
    return rows.withColumn("month", month)


@view("all", "rules", *_FLAGGED, "defects")
def screened(t: Tables, p: dict) -> DataFrame:
    """All flags: module, view, key, metric, value, rule, severity, month."""
    bounds = t("rules")
    both = measured(t, p).where("value IS NOT NULL").join(bounds, "metric").where((F.col("value") < F.col("low")) | (F.col("value") > F.col("high")))
    return both.select("module", "view", "key", "metric", "value", "rule", "severity", "month").distinct()


@view("all", "screened", "declarations")
def flags(t: Tables, p: dict) -> DataFrame:
    """The flags with their state; a flag that names no site is declared only by a
    declaration for any."""
    held = t("screened")
    value = F.from_json("key", "map<string,string>")
    placed = held.withColumns({c: value[F.lit(c)] for c in SITE})
    return governance.downgrade(placed, t("declarations"), SITE).drop(*SITE)


@view("all", "flags", "now")
def digest(t: Tables, p: dict) -> DataFrame:
    """Per module its number of flags, and the first by the amount that they are about."""
    amount = screen.flag_amounts(_in(t("now"), p), t("flags").select("key").distinct())
    return screen.digest(t("flags").join(amount, "key"), 10)


@view("all", "flags", "now")
def drilled(t: Tables, p: dict) -> DataFrame:
    return screen.drill_flags(t("now"), t("flags"), p["month"])


@view("all", "flags", "now")
def impact(t: Tables, p: dict) -> DataFrame:
    return screen.impact_of_grains(_in(t("now"), p), t("flags"), SITE)


@view("all", "flags", "now")
def acceptance(t: Tables, p: dict) -> DataFrame:
    """Twelve modules by site: pass, explained, fail, or not checked for want of an
    input; with the flags about the site and the share of its amount they touch."""
    unchecked = [m for m, needed in NEEDED.items() if set(needed) & set(p["absent"])]
    return screen.module_acceptance(_in(t("now"), p), t("flags"), SITE, MODULES, unchecked)


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], INPUTS[name])
