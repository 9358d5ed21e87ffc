"""Arrival, completeness, and this push against the last."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import join_same
from ..functions.numeric import ratio, total


def arrived(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and items per key. Rows are counted per key and item first, so no task holds
    the items of its keys at once."""
    per_item = df.groupBy(*keys, "item").agg(F.count("*").alias("_n"))
    return per_item.groupBy(keys).agg(F.sum("_n").alias("rows"), F.count("item").alias("items"))


def arrival(df: DataFrame, sites: DataFrame, months: DataFrame) -> DataFrame:
    """B1: the full grid of sites x months, with rows and items, and what is missing."""
    return arrival_grid(arrived(df, [*sites.columns, *months.columns]), sites, months)


def arrival_grid(there: DataFrame, sites: DataFrame, months: DataFrame) -> DataFrame:
    """B1 from what ``arrived`` counted."""
    keys = [*sites.columns, *months.columns]
    # both sides are short lists of names
    grid = sites.distinct().crossJoin(months.distinct())
    out = join_same(grid, there, keys, "left")
    return out.select(*keys, F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("items", F.lit(0)).alias("items"), F.col("rows").isNull().alias("missing"))


def duplicates(df: DataFrame, key: list[str], amount: str) -> DataFrame:
    """B2: by multiplicity n > 1 of a key: groups, rows beyond the first, and
    their amount (the group's less its greatest)."""
    groups = df.groupBy(key).agg(F.count("*").alias("n"), (F.sum(amount) - F.max(amount)).alias("over")).where("n > 1")
    return groups.groupBy("n").agg(F.count("*").alias("groups"), F.sum(F.col("n") - 1).alias("excess_rows"), total("over").alias("excess_amt"))


def fill_rate(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Share of rows with a value (not null, not empty), long by column."""
    share = [ratio(F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != "")), F.count("*")).alias(c) for c in columns]
    return df.groupBy(keys).agg(*share).unpivot(keys, columns, "field", "filled")


def push_diff(cur: DataFrame, prev: DataFrame, key: list[str], measures: list[str], amount: str = "amt", by: list[str] | None = None) -> DataFrame:
    """Keys added, removed, changed or same between pushes, with the amount.

    ``by`` groups the result; months that only this push has count as new.
    """
    by = by or ["month"]
    side = lambda d, s: d.select(*key, F.struct(*measures).alias(f"_{s}"), F.col(amount).alias(f"_{s}_amt"))
    both = join_same(side(cur, "c"), side(prev, "p"), key, "full_outer")
    status = F.when(F.col("_p").isNull(), "added").when(F.col("_c").isNull(), "removed").when(F.col("_c").eqNullSafe(F.col("_p")), "same").otherwise("changed")
    zero = F.lit(0).cast("decimal(20,4)")
    effect = F.coalesce("_c_amt", zero) - F.coalesce("_p_amt", zero)
    return both.withColumns({"status": status, "_e": effect}).groupBy(*by, "status").agg(F.count("*").alias("keys"), total("_e").alias("effect"))


#: Parts that the keys below one branch of a push's tree are dealt to.
PARTS = 256


def _part(key: list[str]) -> F.Column:
    return F.pmod(F.xxhash64(*key), F.lit(PARTS)).cast("int")


def push_tree(df: DataFrame, key: list[str], measures: list[str], branch: list[str], amount: str = "amt") -> DataFrame:
    """The checksums of a push: per ``branch`` (such as month and site) and part of
    its keys the rows, their hash sum and their amount. Land it with the run: the next
    push is compared with it before any row of this one is read again."""
    row = F.xxhash64(*key, *measures).cast("decimal(38,0)")
    return df.groupBy(*branch, _part(key).alias("part")).agg(F.count("*").alias("rows"), F.sum(row).alias("checksum"), F.sum(amount).alias("amt"))


def changed_parts(cur_tree: DataFrame, prev_tree: DataFrame) -> DataFrame:
    """The branches and parts in which two trees differ."""
    keys = [c for c in cur_tree.columns if c not in ("rows", "checksum", "amt")]
    sums = lambda t, s: t.select(*keys, F.struct("rows", "checksum").alias(s))
    both = join_same(sums(cur_tree, "_c"), sums(prev_tree, "_p"), keys, "full_outer")
    return both.where(~F.col("_c").eqNullSafe(F.col("_p"))).select(keys)


def only_parts(df: DataFrame, parts: DataFrame, key: list[str]) -> DataFrame:
    """The rows of a push in these branches and parts. The parts go to the tasks as one
    row a branch (a mark for each part), so the rows stay where they are."""
    branch = [c for c in parts.columns if c != "part"]
    marks = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda i: F.array_contains(F.col("_s"), i))
    held = parts.groupBy(branch).agg(F.collect_set("part").alias("_s")).select(*branch, marks.alias("_marks"))
    both = join_same(df, held.hint("broadcast"), branch)
    return both.where(F.get("_marks", _part(key))).select(*df.columns)


def push_diff_by_tree(cur: DataFrame, prev: DataFrame, key: list[str], measures: list[str], amount: str = "amt", by: list[str] | None = None, trees: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """B4 for pushes that are mostly the same: the rows of ``push_diff``, but only parts
    whose checksums differ are joined; the keys of the others are the same.

    ``trees``: what ``push_tree`` gave for both with ``by`` as the branch, if landed.
    """
    by = by or ["month"]
    a, b = trees or (push_tree(cur, key, measures, by, amount), push_tree(prev, key, measures, by, amount))
    parts = changed_parts(a, b)
    found = push_diff(only_parts(cur, parts, key), only_parts(prev, parts, key), key, measures, amount, by)
    alike = join_same(a, parts, parts.columns, "left_anti").select(*by, F.lit("same").alias("status"), F.col("rows").alias("keys"), F.lit(0.0).alias("effect"))
    return found.unionByName(alike).groupBy(*by, "status").agg(F.sum("keys").alias("keys"), F.sum("effect").alias("effect"))


def restatement_by_tree(cur_tree: DataFrame, prev_tree: DataFrame, keys: list[str]) -> DataFrame:
    """B5 from two trees alone."""
    return restatement(cur_tree, prev_tree, keys)


def restatement(cur: DataFrame, prev: DataFrame, keys: list[str]) -> DataFrame:
    """Per past period, this push's amount over the last push's."""
    a, b = (d.groupBy(keys).agg(F.sum("amt").alias(n)) for d, n in ((cur, "cur"), (prev, "prev")))
    out = join_same(a, b, keys, "full_outer")
    return out.select(*keys, F.col("cur").cast("double").alias("cur_amt"), F.col("prev").cast("double").alias("prev_amt"), ratio(F.col("cur"), F.col("prev")).alias("ratio"))
