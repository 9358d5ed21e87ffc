"""Distinct integers at several grains, each built from the finer one.

At the finest grain the integers of a group are words of 64 bits, one for each 64
neighbours that it has any of; a coarser group's are the bitwise or of its parts'. So
the items are shuffled once, at the finest grain, and no row is repeated for each
grain. What a word stands for is exact at any density: at worst it holds one item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written


def item_words(df: DataFrame, keys: list[str], item: str, sums: list[str]) -> DataFrame:
    """(keys, _w, _bits, sums): the finest grain. A null item is summed, but counts as
    none."""
    n = F.col(item).cast("long")
    bits = F.when(n.isNotNull(), F.expr(f"shiftleft(1L, CAST(CAST({item} AS BIGINT) & 63 AS INT))")).otherwise(0)
    return df.groupBy(*keys, F.shiftright(n, 6).alias("_w")).agg(F.bit_or(bits).alias("_bits"), *(F.sum(c).alias(c) for c in sums))


def united(words: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """The words of coarser groups."""
    return words.groupBy(*keys, "_w").agg(F.bit_or("_bits").alias("_bits"), *(F.sum(c).alias(c) for c in sums))


def counted(words: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """(keys, items, sums) of groups; without keys the total, if there is any row."""
    group = words.groupBy(*(keys or [F.lit(1).alias("_all")]))
    out = group.agg(F.sum(F.bit_count("_bits")).cast("long").alias("items"), *(F.sum(c).alias(c) for c in sums))
    return out.select(*keys, "items", *sums)


def by_level(df: DataFrame, keys: list[str], item: str, sums: list[str], least: int = 0) -> DataFrame:
    """(keys, gid, items, sums) of every prefix of ``keys`` of at least ``least``
    columns; the others are null, and ``gid`` says which, as ``grouping_id`` does."""
    words = written(item_words(df, keys, item, sums), "words")
    out = None
    for n in range(len(keys), least - 1, -1):
        if n < len(keys):
            words = written(united(words, keys[:n], sums), "words")
        none = [F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys[n:]]
        rows = counted(words, keys[:n], sums).select(*keys[:n], *none, F.lit((1 << (len(keys) - n)) - 1).alias("gid"), "items", *sums)
        out = rows if out is None else out.unionByName(rows)
    return out


def by_prefix(df: DataFrame, path: str, item: str, sums: list[str]) -> DataFrame:
    """(path, items, sums) of every prefix of an array column, from the longest up."""
    words = written(item_words(df.where(F.size(path) > 0), [path], item, sums), "words")
    deepest = words.agg(F.max(F.size(path))).first()[0] or 1
    out, carried = None, None
    for d in range(deepest, 0, -1):
        level = words.where(F.size(path) == d)
        level = level if carried is None else written(united(level.unionByName(carried), [path], sums), "words")
        rows = counted(level, [path], sums)
        out = rows if out is None else out.unionByName(rows)
        carried = level.withColumn(path, F.slice(path, 1, d - 1)) if d > 1 else None
    return out
