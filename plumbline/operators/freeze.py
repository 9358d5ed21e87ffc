"""Scope, frozen inputs, landed results, fingerprints, messages."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import join_same
from ..functions.text import masked


def apply_scope(df: DataFrame, scope: DataFrame, keys: list[str]) -> DataFrame:
    """A2: rows whose keys are in the frozen scope."""
    return join_same(df, scope.select(keys).distinct(), keys, "left_semi")


def freeze(tables: dict[str, DataFrame], run_id: str, path: str) -> None:
    """A3: store a run's inputs, one folder a table, partitioned by run; a run that
    is done again takes the place of what it stored before. An empty table keeps its
    columns."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}/run_id={run_id}")


def thaw(spark: SparkSession, name: str, run_id: str, path: str) -> DataFrame:
    """What ``freeze`` stored."""
    return spark.read.parquet(f"{path}/{name}/run_id={run_id}")


def merge_rulings(standard: DataFrame, rulings: DataFrame, key: str, value: str = "rule") -> DataFrame:
    """A4: the standard with rulings put over it; new keys are added. ``source``
    says where a rule is from."""
    new = rulings.select(key, F.col(value).alias("_v"), F.lit(True).alias("_new"))
    both = join_same(standard.select(key, value, F.lit(True).alias("_old")), new, [key], "full_outer")
    source = F.when(F.col("_new").isNull(), "standard").when(F.col("_old").isNull(), "new").otherwise("ruling")
    return both.select(key, F.coalesce("_v", value).alias(value), source.alias("source"))


def land(df: DataFrame, run_id: str, view: str, text: str, path: str, made: dict | None = None) -> None:
    """A5: store a view's rows and what made them; again in their place.

    ``text`` is for people. ``made`` is for ``recorded``: the operator's name, the names
    of the tables it was given and its parameters, with a hash of the query's plan.
    """
    df.write.mode("overwrite").parquet(f"{path}/rows/{run_id}/{view}")
    # the hash of a plan is the engine's: equal ones mean the same query, others needn't
    made = made and {**made, "plan": df.semanticHash()}
    row = [(text, json.dumps(made, sort_keys=True, ensure_ascii=False) if made else None)]
    df.sparkSession.createDataFrame(row, "text string, made string").coalesce(1).write.mode("overwrite").parquet(f"{path}/catalog/run_id={run_id}/view={view}")


def landed(spark: SparkSession, run_id: str, view: str, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows/{run_id}/{view}")


def recorded(spark: SparkSession, run_id: str, view: str, path: str) -> dict:
    """What made a landed view."""
    row = spark.read.schema("text string, made string").parquet(f"{path}/catalog/run_id={run_id}/view={view}").first()
    if row["made"] is None:
        raise ValueError(f"{view!r} of run {run_id!r} was landed without a record of what made it")
    return json.loads(row["made"])


def fingerprint(df: DataFrame, updated: str | None = None) -> DataFrame:
    """One row with the row count, the last update and an order-free checksum.

    Hashes are summed, not xor-ed: rows that are doubled must change it.
    """
    last = F.max(updated) if updated else F.lit(None).cast("date")
    return df.agg(F.count("*").alias("rows"), last.alias("updated"), F.sum(row_hash(df)).alias("checksum"))


def row_hash(df: DataFrame) -> F.Column:
    return F.xxhash64(*df.columns).cast("decimal(38,0)")


def observed(df: DataFrame, updated: str) -> tuple[DataFrame, Observation]:
    """A6 without a scan of its own: ``df``, and its fingerprint once a job has read it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.max(updated).alias("updated"), F.sum(row_hash(df)).alias("checksum")), seen


def unchanged(a: DataFrame, b: DataFrame) -> bool:
    """Whether two fingerprints say the same: the source stood still."""
    return a.first() == b.first()


def month_checksums(df: DataFrame) -> DataFrame:
    """A6 by month: rows and checksum, from a source or from a base with checks."""
    if "checksum" in df.columns:
        return df.groupBy("month").agg(F.sum("rows").alias("rows"), F.sum("checksum").alias("checksum"))
    return df.groupBy("month").agg(F.count("*").alias("rows"), F.sum(row_hash(df)).alias("checksum"))


def changed_months(a: DataFrame, b: DataFrame) -> DataFrame:
    """Months whose rows differ between two results of ``month_checksums``."""
    side = lambda d, s: d.select("month", F.struct("rows", "checksum").alias(s))
    both = join_same(side(a, "_a"), side(b, "_b"), ["month"], "full_outer")
    return both.where(~F.col("_a").eqNullSafe(F.col("_b"))).select("month")


def stamp(df: DataFrame) -> DataFrame | None:
    """The files that a table is read from, with size and time of change; no row of the
    table is read. None for a source that has no files."""
    files = df.inputFiles()
    if not files:
        return None
    return df.sparkSession.read.format("binaryFile").load(files).select("path", "length", "modificationTime")


def intake(new: DataFrame, frozen: DataFrame, keys: list[str], text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """Messages not frozen yet, with personal data masked and attachment
    columns dropped."""
    return join_same(new, frozen.select(keys).distinct(), keys, "left_anti").withColumn(text, masked(F.col(text))).drop(*drop)


def recompute(landed_rows: DataFrame, again: DataFrame) -> DataFrame:
    """M5: rows that are only in the landed result, and only in the new one, as
    (side, rows); repeated rows count."""
    sides = (("landed", landed_rows.exceptAll(again)), ("recomputed", again.exceptAll(landed_rows)))
    a, b = (d.agg(F.count("*").alias("rows")).select(F.lit(k).alias("side"), "rows") for k, d in sides)
    return a.union(b)
