"""Exact quantiles of groups of any size, by distributed selection.

A mergeable sketch gives cuts on both sides of each wanted rank. A second pass counts
the rows between the cuts, which says in which bucket a rank lies, whatever the sketch
did; only the distinct values of that bucket are ranked. So no task holds more of a
group than a few parts in ``accuracy`` of its distinct values.

The values are written to the shared folder once, and so are the short tables of cuts
and of wanted places: the passes read them, and what made the values runs once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from .joins import join_same

#: Of the sketch: ranks are off by at most a group's rows over this.
ACCURACY = 10_000


def _buckets(df: DataFrame, keys: list[str], value: str, at: list[float], accuracy: int) -> DataFrame:
    """(keys, _b, _v): each value with the number of cuts below it."""
    rows = written(df.select(*keys, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL"), "values")
    margin = 2.0 / accuracy
    probes = sorted({min(max(q + side * margin, 0.0), 1.0) for q in at for side in (-1, 1)})
    cuts = written(rows.groupBy(keys).agg(F.percentile_approx("_v", probes, accuracy).alias("_cuts")), "cuts")
    bucket = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    return join_same(rows, cuts, keys).select(*keys, bucket.alias("_b"), "_v")


def _wanted(placed: DataFrame, keys: list[str], at: dict[str, float]) -> DataFrame:
    """(keys, _b, _name, _rank, _weight): for each quantile the one or two places in
    order that it lies between, counted from 0 within their bucket."""
    counted = placed.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_c"))
    group = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("_c").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = counted.select(*keys, "_b", "_c", before.alias("_before"), F.sum("_c").over(group).alias("_n"))
    places = []
    for name, q in at.items():
        spot = (F.col("_n") - 1).cast("double") * F.lit(q)
        low, high = F.floor(spot), F.ceil(spot)
        places.append(F.struct(F.lit(name).alias("_name"), low.alias("_rank"), F.when(low == high, F.lit(1.0)).otherwise(high - spot).alias("_weight")))
        places.append(F.struct(F.lit(name).alias("_name"), F.when(low != high, high).alias("_rank"), (spot - low).alias("_weight")))
    rows = counted.select(*keys, "_b", "_c", "_before", F.explode(F.array(*places)).alias("_p")).select(*keys, "_b", "_c", "_before", "_p.*")
    inside = (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_c"))
    return rows.where(inside).select(*keys, "_b", "_name", (F.col("_rank") - F.col("_before")).alias("_rank"), "_weight")


def ranked_part(df: DataFrame, keys: list[str], value: str, at: dict[str, float], accuracy: int = ACCURACY) -> tuple[DataFrame, DataFrame]:
    """The places that are wanted, and (keys, _b, _v, _c): the distinct values, with
    their counts, of the buckets that hold them."""
    placed = _buckets(df, keys, value, list(at.values()), accuracy)
    wanted = written(_wanted(placed, keys, at), "places")
    held = join_same(placed, wanted.select(*keys, "_b").distinct(), [*keys, "_b"], "left_semi")
    return wanted, held.groupBy(*keys, "_b", "_v").agg(F.count(F.lit(1)).alias("_c"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, at: dict[str, float], accuracy: int = ACCURACY) -> DataFrame:
    """(keys, the names of ``at``): interpolated quantiles, as ``percentile`` gives
    them, of the values that aren't null. A group without any gives no row."""
    wanted, part = ranked_part(df, keys, value, at, accuracy)
    upto = F.sum("_c").over(Window.partitionBy(*keys, "_b").orderBy("_v"))
    part = part.withColumn("_upto", upto)
    found = join_same(part, wanted, [*keys, "_b"]).where((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_c")))
    pick = lambda name: F.sum(F.when(F.col("_name") == name, F.col("_weight") * F.col("_v"))).alias(name)
    return found.groupBy(keys).agg(*(pick(name) for name in at))


def quantiles(df: DataFrame, keys: list[str], value: str, at: dict[str, float], accuracy: int | None = None) -> DataFrame:
    """Exact quantiles, or, where an ``accuracy`` is given, those of the sketch."""
    if accuracy is None:
        return exact_quantiles(df, keys, value, at)
    return df.groupBy(keys).agg(*(F.percentile_approx(value, q, accuracy).alias(name) for name, q in at.items()))
