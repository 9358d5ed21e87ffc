"""Label quality: samples for judgement, verdicts, whole-leaf estimates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import join_same
from ..functions.numeric import ratio, rounded, total
from ..functions.selection import quantiles
from ..sources.scratch import written


def label_sample(df: DataFrame, leaf: str, n: int, seed: str = "1", top: int = 3, percentile: float = 0.95, accuracy: int | None = None) -> DataFrame:
    """Per leaf a repeatable random n, the greatest by amount, and items at or
    above a price percentile; one row an item, with why it is in.

    The reason must be kept: only the random stratum speaks for the leaf.
    """
    items = df.groupBy(leaf, "item").agg(F.sum("qty").alias("q"), F.sum("amt").alias("a")).where("q <> 0")
    # every stratum reads the items again, and what made them runs once
    items = written(items.withColumn("price", F.col("a").cast("double") / F.col("q").cast("double")), "items")
    draw = F.md5(F.concat(F.lit(seed + "|"), F.col("item").cast("string")))
    by_hash, by_amount = (Window.partitionBy(leaf).orderBy(*o) for o in ((draw, "item"), (F.desc("a"), "item")))
    strata = (
        items.withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= n).select(leaf, "item", F.lit("random").alias("reason")),
        items.withColumn("r", F.row_number().over(by_amount)).where(F.col("r") <= top).select(leaf, "item", F.lit("top").alias("reason")),
        join_same(items, quantiles(items, [leaf], "price", {"cut": percentile}, accuracy), [leaf]).where("price >= cut").select(leaf, "item", F.lit("costly").alias("reason")),
    )
    every = strata[0].unionByName(strata[1]).unionByName(strata[2])
    return every.groupBy(leaf, "item").agg(F.array_join(F.sort_array(F.collect_set("reason")), ",").alias("reason"))


def verdicts(judged: DataFrame, item: str = "item") -> DataFrame:
    """The latest verdict of each item; anything but match and mismatch is
    undecided. Ties in time go to the greater verdict text."""
    last = judged.groupBy(item).agg(F.max_by("verdict", F.struct("judged_at", "verdict")).alias("v"))
    kind = F.when(F.col("v").isin("match", "mismatch"), F.col("v")).otherwise("undecided")
    return last.select(item, kind.alias("verdict"))


def leaf_mismatch(sample: DataFrame, verdict: DataFrame, keys: list[str], item: str = "item", amount: str = "amt") -> DataFrame:
    """Per leaf: decided, mismatched, rate, and rate by amount."""
    both = sample.join(verdict, item).where("verdict IN ('match', 'mismatch')")
    wrong = F.col("verdict") == "mismatch"
    return both.groupBy(keys).agg(
        F.count("*").alias("judged"), F.count_if(wrong).alias("mismatched"),
        ratio(F.count_if(wrong), F.count("*")).alias("rate"),
        ratio(F.coalesce(F.sum(F.when(wrong, F.col(amount))), F.lit(0)), F.sum(amount)).alias("amt_rate"),
    )


def clustered(sample: DataFrame, verdict: DataFrame, totals: DataFrame, keys: list[str], least: int = 2, rate: float = 0.1, item: str = "item", amount: str = "amt") -> DataFrame:
    """Leaves whose mismatches cluster, with the wrong amount of the whole leaf.

    The random stratum's rate is applied to what wasn't judged; what was found
    wrong is added as it stands, as the other strata are biased. ``totals``: keys
    and ``total_amt``.
    """
    both = sample.join(verdict, item).where("verdict IN ('match', 'mismatch')")
    wrong, drawn = F.col("verdict") == "mismatch", F.contains(F.col("reason"), F.lit("random"))
    money = lambda c: F.coalesce(F.sum(F.when(c, F.col(amount))), F.lit(0)).cast("double")
    out = both.groupBy(keys).agg(
        F.count("*").alias("judged"), F.count_if(wrong).alias("mismatched"), money(F.lit(True)).alias("judged_amt"), money(wrong).alias("found_amt"),
        (F.count_if(wrong & drawn) / F.when(F.count_if(drawn) > 0, F.count_if(drawn))).alias("random_rate"),
    )
    out = out.where((F.col("mismatched") >= least) & (F.col("mismatched") >= rate * F.col("judged")))
    out = join_same(out, totals, keys)
    estimate = F.col("random_rate") * (F.col("total_amt") - F.col("judged_amt")) + F.col("found_amt")
    return out.select(*keys, "judged", "mismatched", "found_amt", rounded(F.col("random_rate")).alias("random_rate"), rounded(estimate, 4).alias("wrong_amt"))


def unknown_labels(df: DataFrame, standard: DataFrame, label: str) -> DataFrame:
    """Labels that the frozen standard doesn't have."""
    sums = df.groupBy(label).agg(F.count("*").alias("rows"), total("amt").alias("amt"))
    return sums.join(standard.select(label).distinct(), label, "left_anti")


def tag_fill(df: DataFrame, keys: list[str], tags: str) -> DataFrame:
    """How many of a key's rows have each attribute tag. ``tags`` is JSON."""
    kept = df.select(*keys, F.map_entries(F.from_json(tags, "map<string,string>")).alias("_t"))
    rows = kept.groupBy(keys).agg(F.count("*").alias("rows"))
    filled = kept.select(*keys, F.explode("_t").alias("_e")).where("_e.value IS NOT NULL AND _e.value <> ''").groupBy(*keys, F.col("_e.key").alias("tag")).agg(F.count("*").alias("filled"))
    return join_same(filled, rows, keys).select(*keys, "tag", "filled", ratio(F.col("filled"), F.col("rows")).alias("share"))


def label_churn(cur: DataFrame, prev: DataFrame, item: str, label: str) -> DataFrame:
    """Items whose label differs from the last push's, as a matrix by this
    push's amount; no label (null) is one to come from and to go to."""
    now = cur.groupBy(item, label).agg(F.sum("amt").alias("a"))
    then = prev.select(item, F.col(label).alias("was")).distinct()
    moved = join_same(now, then, [item]).where(~F.col(label).eqNullSafe(F.col("was")))
    return moved.groupBy(F.col("was").alias("label_from"), F.col(label).alias("label_to")).agg(F.count("*").alias("items"), total("a").alias("amt"))
