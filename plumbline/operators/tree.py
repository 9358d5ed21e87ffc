"""The platform category tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distinct import by_prefix
from ..functions.joins import join_same
from ..functions.numeric import ratio


def tree_totals(df: DataFrame, path: str = "path") -> DataFrame:
    """Items, volume and amount of every node, a row's path being counted at
    each of its prefixes. ``path`` is an array from the root."""
    out = by_prefix(df, path, "item", ["qty", "amt"])
    return out.select(F.array_join(path, "/").alias("node"), F.size(path).alias("depth"), "items", F.col("qty").cast("double").alias("qty"), F.col("amt").cast("double").alias("amt"))


def tree_diff(cur: DataFrame, base: DataFrame, node: str = "node", parent: str = "root") -> DataFrame:
    """Nodes that are new, gone, or under another parent; one row a node, with
    the least of its parents."""
    # of a node with several parents, all are told: as a list, so a node is one row
    listed = lambda d, p: d.groupBy(node).agg(F.array_join(F.sort_array(F.collect_set(F.col(parent).cast("string"))), ",").alias("_l"), F.min(parent).alias(p))
    a, b = listed(cur, "parent").withColumn("_a", F.lit(True)), listed(base, "base_parent").withColumn("_b", F.lit(True))
    both = join_same(a, b.withColumnRenamed("_l", "_m"), [node], "full_outer")
    state = F.when(F.col("_b").isNull(), "new").when(F.col("_a").isNull(), "gone").when(~F.col("_l").eqNullSafe(F.col("_m")), "moved")
    return both.withColumn("state", state).where("state IS NOT NULL").select(node, "state", "parent", "base_parent")


def leaf_mix(df: DataFrame, leaf: str, node: str, by: list[str] | None = None) -> DataFrame:
    """What a leaf is made of by platform node, over the full population, within
    the keys ``by``, such as the site."""
    keys = [*(by or []), leaf]
    out = df.groupBy(*keys, node).agg(F.count_distinct("item").alias("items"), F.sum("amt").alias("a"))
    whole = Window.partitionBy(keys)
    return out.select(*keys, node, "items", F.col("a").cast("double").alias("amt"), ratio(F.col("items"), F.sum("items").over(whole)).alias("item_share"), ratio(F.col("a"), F.sum("a").over(whole)).alias("share"))


def rare_roots(df: DataFrame, leaf: str, root: str = "root", most: float = 0.02) -> DataFrame:
    """I4: roots that make little of a leaf's amount."""
    return leaf_mix(df, leaf, root).where(F.col("share") < most)


def leaf_misplaced(df: DataFrame, accepted: DataFrame, leaf: str, node: str) -> DataFrame:
    """A leaf's amount outside its accepted nodes, and its share of the leaf."""
    sums = df.groupBy(leaf, node).agg(F.sum("amt").alias("a"))
    whole = sums.groupBy(leaf).agg(F.sum("a").alias("t"))
    out = join_same(sums, accepted.select(leaf, node).distinct(), [leaf, node], "left_anti").groupBy(leaf).agg(F.sum("a").alias("a"), F.count("*").alias("nodes"))
    return join_same(out, whole, [leaf]).select(leaf, "nodes", F.col("a").cast("double").alias("amt"), ratio(F.col("a"), F.col("t")).alias("share"))
