"""Keys of flags: which columns a flag is about, and their values.

A key is JSON text with one field a column, in order, nulls kept:
``{"month":"2001-06-01","country":null}``. So keys of any grain share one column, two
keys never read alike, and a key says by itself which rows it is about: those that
agree with all of its fields. A column that it doesn't name may be anything.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from .joins import join_same

#: Keys of a grain that go to every task; more are joined by a shuffle.
SHORT = 100_000


def key_text(*columns: str) -> Column:
    """The key of a row for these columns."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def grains(flags: DataFrame) -> list[list[str]]:
    """The sets of columns that the flags' keys name, coarse ones first: as many as
    there are kinds of results, not flags."""
    rows = flags.select(F.array_sort(F.json_object_keys("key")).alias("names")).distinct().collect()
    return sorted((r["names"] for r in rows if r["names"]), key=lambda n: (len(n), n))


def of_grain(flags: DataFrame, names: list[str], df: DataFrame) -> DataFrame:
    """The flags whose keys name just these columns, with each as a column of the
    type that it has in ``df`` (in place of one of the flags' own of that name)."""
    held = flags.where(F.array_sort(F.json_object_keys("key")) == F.array(*map(F.lit, names)))
    value = F.from_json("key", "map<string,string>")
    return held.select(*(c for c in flags.columns if c not in names), *(value[F.lit(n)].cast(df.schema[n].dataType).alias(n) for n in names))


def short(keys: DataFrame) -> DataFrame:
    """A list of keys, marked to be broadcast if it is short: only a long one then moves
    the rows that it is looked up for. ``keys`` is counted, so it should be written."""
    return keys.hint("broadcast") if keys.limit(SHORT + 1).count() <= SHORT else keys


def least_cover(flags: DataFrame, df: DataFrame) -> list[tuple[list[str], DataFrame]]:
    """For each grain the distinct keys, without those that a coarser flag holds: what
    agrees with them agrees with that flag."""
    out: list[tuple[list[str], DataFrame]] = []
    for names in grains(flags):
        keys = of_grain(flags, names, df).select(names).distinct()
        for coarse, held in out:
            if set(coarse) < set(names):
                keys = join_same(keys, held, coarse, "left_anti")
        out.append((names, keys))
    return out


def touched(df: DataFrame, flags: DataFrame) -> DataFrame:
    """``df`` with ``touched``: whether any of the flags is about a row. The rows aren't
    multiplied: each grain's distinct keys are looked up once."""
    marks = []
    # read once for each grain, and what made them runs once
    flags = written(flags.select("key").distinct(), "flags")
    for i, (names, keys) in enumerate(least_cover(flags, df)):
        marks.append(f"_touched_{i}")
        df = join_same(df, short(keys).withColumn(marks[-1], F.lit(True)), names, "left")
    hit = reduce(lambda a, b: a | b, (F.coalesce(m, F.lit(False)) for m in marks), F.lit(False))
    return df.withColumn("touched", hit).drop(*marks)


def touching(df: DataFrame, flags: DataFrame, name: str) -> DataFrame:
    """``df`` with ``touching``: the different values of ``name`` (a column of few
    values, such as the module) among the flags that are about a row."""
    marks = []
    flags = written(flags.select("key", name).distinct(), "flags")
    for i, names in enumerate(grains(flags)):
        marks.append(f"_touching_{i}")
        keys = of_grain(flags, names, df).groupBy(names).agg(F.collect_set(name).alias(marks[-1]))
        df = join_same(df, short(keys), names, "left")
    none = F.array().cast("array<string>")
    every = F.array_distinct(F.flatten(F.array(*(F.coalesce(m, none) for m in marks)))) if marks else none
    return df.withColumn("touching", every).drop(*marks)
