"""Connected components of a graph of any size, by stars.

Each round hangs a node's neighbours on the least of them (first those above it, then
those below), so that chains halve and components become stars around their least
node. Every step is a sum by node and a join: no node's neighbours are collected, and a
hot node's join can be split. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written


def _hung(both: DataFrame, above: bool) -> DataFrame:
    """(u, v) rows; each v on one side of u, and, below, u itself, on the least of them."""
    least = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
    side = both.where("v > u" if above else "v < u")
    hung = side.join(least, "u")
    out = hung.select(F.col("v").alias("a"), "m")
    if not above:
        out = out.union(hung.select(F.col("u").alias("a"), "m"))
    return out.where("a <> m").select(F.col("a").alias("u"), F.col("m").alias("v")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node that each node is linked with over any number
    of edges. Nulls link nothing; a node without an edge to another has no row."""
    held = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    held, mark = written(held, "edges"), None
    while True:
        new = held.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if new == mark:
            return held.select(F.col("u").alias("node"), F.col("v").alias("component")).union(held.select("v", "v").distinct())
        mark = new
        held = _hung(held.union(held.select("v", "u")), above=True)
        held = written(_hung(held, above=False), "edges")
