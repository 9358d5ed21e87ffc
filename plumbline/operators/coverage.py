"""Is a change due to which items are covered, or to their estimates?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import join_same
from ..functions.numeric import rounded, total


def _two_months(df: DataFrame, month: str, base_month: str, keys: list[str], how: str) -> DataFrame:
    """Item sums of both months side by side: q0, a0, q1, a1."""
    by = [*keys, "item"]
    side = lambda m, s: df.where(F.col("month") == F.lit(m).cast("date")).groupBy(by).agg(F.sum("qty").alias(f"q{s}"), F.sum("amt").alias(f"a{s}"))
    return join_same(side(base_month, 0), side(month, 1), by, how)


def coverage_split(df: DataFrame, month: str, base_month: str, keys: list[str]) -> DataFrame:
    """change = items added - items lost + change on items in both; exact."""
    both = _two_months(df, month, base_month, keys, "full_outer")
    zero = F.lit(0).cast("decimal(20,4)")
    a0, a1 = F.col("a0"), F.col("a1")
    return both.groupBy(keys).agg(
        F.sum(F.when(a0.isNull(), a1).otherwise(zero)).cast("double").alias("added"),
        F.sum(F.when(a1.isNull(), a0).otherwise(zero)).cast("double").alias("lost"),
        F.sum(F.when(a0.isNotNull() & a1.isNotNull(), a1 - a0).otherwise(zero)).cast("double").alias("matched"),
        F.sum(F.coalesce(a1, zero) - F.coalesce(a0, zero)).cast("double").alias("change"),
    )


def count_mean_split(df: DataFrame, month: str, base_month: str, keys: list[str]) -> DataFrame:
    """(n1 - n0) * mean0 by count, n1 * (mean1 - mean0) by mean, for keys that
    both months have."""
    both = _two_months(df, month, base_month, keys, "full_outer").groupBy(keys).agg(
        F.count("a0").alias("n0"), F.count("a1").alias("n1"), total("a0").alias("s0"), total("a1").alias("s1")
    )
    mean0, mean1 = F.col("s0") / F.col("n0"), F.col("s1") / F.col("n1")
    both = both.where("n0 > 0 AND n1 > 0")
    return both.select(*keys, "n0", "n1", rounded((F.col("n1") - F.col("n0")) * mean0, 4).alias("by_count"), rounded(F.col("n1") * (mean1 - mean0), 4).alias("by_mean"))


def volume_price_split(df: DataFrame, month: str, base_month: str, keys: list[str]) -> DataFrame:
    """D3: on items of both months, the volume effect (change of volume at the old
    price, fixed to four decimals per item) and the price effect, the rest."""
    both = _two_months(df, month, base_month, keys, "inner")
    price = F.col("a0").cast("double") / F.col("q0").cast("double")
    effect = F.floor((F.col("q1").cast("double") - F.col("q0").cast("double")) * price * 10000 + 0.5).cast("bigint")
    out = both.groupBy(keys).agg(F.sum(effect).alias("v"), F.sum(((F.col("a1") - F.col("a0")) * 10000).cast("bigint")).alias("c"))
    return out.select(*keys, (F.col("v") / 10000).alias("by_volume"), ((F.col("c") - F.col("v")) / 10000).alias("by_price"), (F.col("c") / 10000).alias("change"))
