"""The four results of standard categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distinct import by_level
from ..functions.joins import join_same
from ..functions.numeric import ratio


def category_results(df: DataFrame, levels: list[str]) -> DataFrame:
    """Items, volume and amount at every level and in total; ``gid`` tells
    which levels are rolled up."""
    out = by_level(df, levels, "item", ["qty", "amt"])
    return out.select(*levels, "gid", "items", F.col("qty").cast("double").alias("qty"), F.col("amt").cast("double").alias("amt"))


def band_of(price: Column, edges: list[float]) -> Column:
    """Index of the price band: how many edges the price reaches."""
    return sum((F.when(price >= e, 1).otherwise(0) for e in edges), F.lit(0)).cast("int")


def price_bands(df: DataFrame, edges: list[float], keys: list[str]) -> DataFrame:
    """Per band and key: items, volume, amount and the share of the key's
    amount. An item's price is its amount over its volume."""
    items = df.groupBy(*keys, "item").agg(F.sum("qty").alias("q"), F.sum("amt").alias("a")).where("q <> 0")
    price = F.col("a").cast("double") / F.col("q").cast("double")
    bands = items.withColumn("band", band_of(price, edges)).groupBy(*keys, "band").agg(F.count("*").alias("items"), F.sum("q").alias("q"), F.sum("a").alias("a"))
    whole = Window.partitionBy(keys)
    return bands.select(*keys, "band", "items", F.col("q").cast("double").alias("qty"), F.col("a").cast("double").alias("amt"), ratio(F.col("a"), F.sum("a").over(whole)).alias("share"))


def band_shift(df: DataFrame, edges: list[float], keys: list[str], month: str, base_month: str) -> DataFrame:
    """Half the sum of absolute changes of band shares between two months."""
    side = lambda m, s: price_bands(df.where(F.col("month") == F.lit(m).cast("date")), edges, keys).select(*keys, "band", F.col("share").alias(s))
    both = join_same(side(month, "now"), side(base_month, "then"), [*keys, "band"], "full_outer")
    step = F.floor(F.abs(F.coalesce("now", F.lit(0.0)) - F.coalesce("then", F.lit(0.0))) * 1000000 + 0.5)
    return both.groupBy(keys).agg((F.sum(step) / 2000000).alias("shift"), F.count("*").alias("bands"))
