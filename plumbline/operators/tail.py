"""Head and long tail."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import join_same
from ..functions.numeric import ratio, rounded, total


def _items(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys, "item").agg(F.sum("qty").alias("q"), F.sum("amt").alias("a"))


def tail_profile(df: DataFrame, keys: list[str], share: float = 0.8, floor: float = 1000.0) -> DataFrame:
    """G1: how many of the greatest items make ``share`` of a key's amount, and
    the count and share of items below a floor."""
    items = _items(df, keys)
    # Items are taken greatest first, by bins of their amount: a bin is needed as a whole
    # or not at all, but for the one in which the share is reached. Only its items are ranked.
    a = F.col("a").cast("double")
    items = items.withColumns({"_bin": F.when(a > 0, F.floor(F.log2(a) * 64)).otherwise(-(1 << 40)), "_below": a < floor})
    bins = items.groupBy(*keys, "_bin").agg(F.sum("a").alias("s"), F.count("*").alias("n"), F.min("a").alias("least"), F.count_if("_below").alias("tail"))
    higher = Window.partitionBy(keys).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumns({"_before": F.coalesce(F.sum("s").over(higher), F.lit(0)), "whole": F.sum("s").over(Window.partitionBy(keys))})
    most = share * F.col("whole").cast("double")
    every = ((F.col("_before") + F.col("s") - F.col("least")).cast("double") < most) & (F.col("least") >= 0)
    none = (F.col("_before").cast("double") >= most) & (F.col("least") >= 0)
    bins = bins.withColumn("head", F.when(every, F.col("n")).when(none, 0))
    order = Window.partitionBy(*keys, "_bin").orderBy(F.desc("a"), "item").rowsBetween(Window.unboundedPreceding, -1)
    inner = join_same(items, bins.where("head IS NULL").select(*keys, "_bin", "_before", "whole"), [*keys, "_bin"])
    inner = inner.withColumn("upto", F.col("_before") + F.coalesce(F.sum("a").over(order), F.lit(0)))
    needed = inner.where(F.col("upto").cast("double") < most).groupBy(keys).agg(F.count("*").alias("_more"))
    sums = bins.groupBy(keys).agg(F.sum("n").alias("items"), F.sum(F.coalesce("head", F.lit(0))).alias("_head"), F.sum("tail").alias("tail_items"))
    out = join_same(sums, needed, keys, "left")
    return out.select(*keys, "items", (F.col("_head") + F.coalesce("_more", F.lit(0))).alias("head_items"), "tail_items", ratio(F.col("tail_items"), F.col("items")).alias("tail_share"))


def head_turnover(df: DataFrame, keys: list[str], n: int, month: str, base_month: str) -> DataFrame:
    """Entries to and exits from the top n items, and what share stayed."""
    order = Window.partitionBy(keys).orderBy(F.desc("a"), "item")

    def head(m: str, flag: str) -> DataFrame:
        top = _items(df.where(F.col("month") == F.lit(m).cast("date")), keys).withColumn("r", F.row_number().over(order)).where(F.col("r") <= n)
        return top.select(*keys, "item", F.lit(1).alias(flag))

    both = join_same(head(month, "now"), head(base_month, "then"), [*keys, "item"], "full_outer")
    entries, exits = F.count("now") - F.count_if(F.col("now").isNotNull() & F.col("then").isNotNull()), F.count("then") - F.count_if(F.col("now").isNotNull() & F.col("then").isNotNull())
    return both.groupBy(keys).agg(entries.alias("entries"), exits.alias("exits"), ratio(F.count_if(F.col("now").isNotNull() & F.col("then").isNotNull()), F.count("*")).alias("overlap"))


def item_concentration(df: DataFrame, keys: list[str]) -> DataFrame:
    """Share of the first and of the first three items, and the sum of squared
    shares."""
    items = _items(df, keys)
    whole = items.groupBy(keys).agg(F.count("*").alias("items"), F.sum("a").cast("double").alias("whole"))
    order = Window.partitionBy(keys).orderBy(F.desc("a"), "item")
    # the limit on ranks goes below the shuffle, so a key's items aren't sorted in one task
    first = items.withColumn("r", F.row_number().over(order)).where("r <= 3")
    top = first.groupBy(keys).agg(F.sum(F.when(F.col("r") == 1, F.col("a"))).cast("double").alias("one"), F.sum("a").cast("double").alias("three"))
    part = F.col("a").cast("double") / F.col("whole")
    # squares as whole numbers, so that the order of summing doesn't matter
    square = join_same(items, whole, keys).groupBy(keys).agg(F.sum(F.floor(part * part * 1e12 + 0.5)).alias("_s"))
    out = join_same(join_same(whole, top, keys), square, keys)
    return out.select(*keys, "items", rounded(F.col("one") / F.col("whole")).alias("top1"), rounded(F.col("three") / F.col("whole")).alias("top3"), rounded(F.col("_s") / 1e12).alias("concentration"))


def steady_price_surge(df: DataFrame, times: float = 5.0, tolerance: float = 0.1) -> DataFrame:
    """Items whose volume on a site rose ``times`` over from one month to the
    next observed while the price stayed: identity mix-ups and broken estimates,
    which a price check can't see."""
    p = df.groupBy("country", "platform", "item", "month").agg(total("qty").alias("q"), total("amt").alias("a")).where("q <> 0")
    p = p.withColumn("price", F.col("a") / F.col("q"))
    before = Window.partitionBy("country", "platform", "item").orderBy("month")
    p = p.withColumns({"q0": F.lag("q").over(before), "price0": F.lag("price").over(before)})
    steady = F.abs(F.col("price") / F.col("price0") - 1) <= tolerance
    return p.where((F.col("q") >= times * F.col("q0")) & steady).select("country", "platform", "item", "month", rounded(F.col("q") / F.col("q0")).alias("volume_times"), F.col("a").alias("amt"))
