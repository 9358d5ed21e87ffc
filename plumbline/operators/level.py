"""Site totals, period changes, breaks of level."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distinct import by_level
from ..functions.joins import join_same
from ..functions.numeric import median_of, ratio, total


def site_totals(df: DataFrame) -> DataFrame:
    """Month, month x country and month x site: amount, volume, items, mean
    price, and the share among its level's rows of the month."""
    out = by_level(df, ["month", "country", "platform"], "item", ["amt", "qty"], least=1).withColumnsRenamed({"amt": "a", "qty": "q"})
    level = Window.partitionBy("month", "gid")
    return out.select(
        "month", "country", "platform", "gid", F.col("a").cast("double").alias("amt"), F.col("q").cast("double").alias("qty"), "items",
        ratio(F.col("a"), F.col("q")).alias("mean_price"), ratio(F.col("a"), F.sum("a").over(level)).alias("share"),
    )


def period_change(df: DataFrame, keys: list[str], measure: str = "amt", months: tuple[int, ...] = (1, 12)) -> DataFrame:
    """A measure against earlier months; null where that month is absent.

    Months are joined by date, as counting rows would skip over gaps.
    """
    now = df.groupBy("month", *keys).agg(F.sum(measure).alias("_v"))
    out = now
    for n in months:
        then = now.select(F.add_months("month", n).alias("month"), *keys, F.col("_v").alias(f"_b{n}"))
        out = join_same(out, then, ["month", *keys], "left")
    changes = [ratio(F.col("_v") - F.col(f"_b{n}"), F.col(f"_b{n}")).alias(f"change_{n}") for n in months]
    return out.select("month", *keys, F.col("_v").cast("double").alias(measure), *changes)


def level_break(df: DataFrame, keys: list[str], n: int = 6, k: float = 3.0, measure: str = "amt") -> DataFrame:
    """Months outside median +- k * MAD of the n months before; a history
    shorter than n, or without spread, breaks nothing."""
    monthly = df.groupBy("month", *keys).agg(total(measure).alias("value"))
    before = F.collect_list("value").over(Window.partitionBy(keys).orderBy("month").rowsBetween(-n, -1))
    out = monthly.withColumn("_h", before).where(F.size("_h") == n).withColumn("median", median_of(F.col("_h")))
    out = out.withColumn("mad", median_of(F.transform("_h", lambda x: F.abs(x - F.col("median")))))
    return out.where((F.col("mad") > 0) & (F.abs(F.col("value") - F.col("median")) > k * F.col("mad"))).select("month", *keys, "value", "median", "mad")
