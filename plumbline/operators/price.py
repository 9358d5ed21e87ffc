"""Prices per key, jumps of an item, outliers among peers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import join_same
from ..functions.numeric import ratio, rounded, total
from ..functions.selection import quantiles
from ..sources.scratch import written


def _priced(df: DataFrame, keys: list[str]) -> DataFrame:
    """Amount and price per key and item; without volume there is no price."""
    items = df.groupBy(keys).agg(total("qty").alias("q"), total("amt").alias("a")).where("q <> 0")
    return items.withColumn("price", F.col("a") / F.col("q"))


def price_summary(df: DataFrame, keys: list[str], accuracy: int | None = None) -> DataFrame:
    """volume-weighted mean price, its quantiles over item-months (exact, or
    to an ``accuracy``), and range."""
    # read for the means, the range and the quantiles; volumes stay decimals, and items
    # without any count for the mean
    grain = ["month", *keys, "item"] if "month" not in keys else [*keys, "item"]
    items = written(df.groupBy(grain).agg(F.sum("qty").alias("qty"), F.sum("amt").alias("amt")), "items")
    sums = items.groupBy(keys).agg(ratio(F.sum("amt"), F.sum("qty"), 4).alias("mean_price"))
    p = _priced(items, grain)
    spread = p.groupBy(keys).agg(rounded(F.min("price"), 4).alias("low"), rounded(F.max("price"), 4).alias("high"))
    inside = quantiles(p, keys, "price", {"p10": 0.1, "p50": 0.5, "p90": 0.9}, accuracy)
    inside = inside.select(*keys, *(rounded(F.col(q), 4).alias(q) for q in ("p10", "p50", "p90")))
    return join_same(join_same(sums, inside, keys), spread, keys)


def price_jump(df: DataFrame, jump: float = 1.5) -> DataFrame:
    """an item's price on a site against its previous month there, where it
    moved by more than ``jump`` up or down."""
    p = _priced(df, ["country", "platform", "item", "month"])
    before = Window.partitionBy("country", "platform", "item").orderBy("month")
    p = p.withColumns({"prior": F.lag("price").over(before), "prior_month": F.lag("month").over(before)})
    moved = F.col("price") / F.col("prior")
    out = p.where((moved > jump) | (moved < 1 / jump))
    return out.select("country", "platform", "item", "month", "prior_month", rounded(moved).alias("moved"), F.col("a").alias("amt"))


def peer_outliers(df: DataFrame, leaf: str, k: float = 3.0, catch_all: str = "-其他", accuracy: int | None = None, by: list[str] | None = None) -> DataFrame:
    """items whose price is more than k * MAD off their leaf's median (within
    the keys ``by``, such as the site); those
    of catch-all leaves are marked, to be listed apart (``leaf_outliers``).
    Medians are exact, or to an ``accuracy``."""
    keys = [*(by or []), leaf]
    # read again for the median, for the spread around it, and at the end
    p = written(_priced(df, [*keys, "item"]), "prices")
    p = join_same(p, quantiles(p, keys, "price", {"median": 0.5}, accuracy), keys)
    off = quantiles(p.withColumn("_off", F.abs(F.col("price") - F.col("median"))), keys, "_off", {"mad": 0.5}, accuracy)
    out = join_same(p, off, keys).where((F.col("mad") > 0) & (F.abs(F.col("price") - F.col("median")) > k * F.col("mad")))
    return out.select(*keys, "item", rounded(F.col("price"), 4).alias("price"), rounded(F.col("price") / F.col("median"), 4).alias("times"), F.col("a").alias("amt"), F.endswith(F.col(leaf), F.lit(catch_all)).alias("catch_all"))


def leaf_outliers(df: DataFrame, leaf: str, k: float = 3.0, catch_all: str = "-其他", accuracy: int | None = None, by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """F3 as two lists: outliers of true leaves, and those of catch-all leaves, whose
    items are no peers of each other."""
    rest = F.coalesce(F.endswith(F.col(leaf), F.lit(catch_all)), F.lit(False))
    one = lambda on: peer_outliers(df.where(rest if on else ~rest), leaf, k, catch_all, accuracy, by).drop("catch_all")
    return one(False), one(True)
