"""K1-K8: own products, earlier corrections, known defects, promises, history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import join_same
from ..functions.numeric import ratio, rounded, total
from ..functions.selection import quantiles


def own_compare(df: DataFrame, truth: DataFrame, keys: list[str], by: list[str], accuracy: int | None = None) -> DataFrame:
    """K1: estimates against true sales per key, summed up by ``by``: matched and
    one-sided counts, and the median and 90th percentile of the relative error
    (exact, or to an ``accuracy``)."""
    est = df.groupBy(keys).agg(F.sum("amt").alias("e"))
    real = truth.groupBy(keys).agg(F.sum("true_amt").alias("t"))
    both = join_same(est, real, keys, "full_outer")
    error = F.when(F.col("t") != 0, F.abs(F.col("e").cast("double") / F.col("t").cast("double") - 1))
    matched = F.col("e").isNotNull() & F.col("t").isNotNull()
    both = both.withColumn("_x", error)
    counts = both.groupBy(by).agg(F.count_if(matched).alias("matched"), F.count_if(F.col("t").isNull()).alias("only_estimate"), F.count_if(F.col("e").isNull()).alias("only_truth"))
    spread = quantiles(both, by, "_x", {"p50": 0.5, "p90": 0.9}, accuracy)
    return join_same(counts, spread.select(*by, rounded(F.col("p50")).alias("p50"), rounded(F.col("p90")).alias("p90")), by, "left")


def carry_over(df: DataFrame, corrections: DataFrame, item: str = "item") -> DataFrame:
    """K2: whether each earlier correction (item, field, wanted) still holds in a
    push: kept, lost, or not applicable as the item is gone or the push has no such column; with its
    amount."""
    fields = [r["field"] for r in corrections.select("field").distinct().collect() if r["field"] in df.columns]
    if not fields:
        return corrections.select(item, "field", "wanted", F.lit("not applicable").alias("state"), F.lit(None).cast("double").alias("amt")).distinct()
    has = df.groupBy(item, *fields).agg(F.sum("amt").alias("a"))
    stack = has.select(item, "a", *(F.col(f).cast("string").alias(f) for f in fields)).unpivot([item, "a"], fields, "field", "value")
    both = join_same(corrections, stack, [item, "field"], "left").groupBy(item, "field", "wanted").agg(
        F.count("a").alias("n"), F.count_if(F.col("value").isNotNull() & (F.col("value") != F.col("wanted"))).alias("off"), total("a").alias("amt")
    )
    state = F.when(F.col("n") == 0, "not applicable").when(F.col("off") > 0, "lost").otherwise("kept")
    return both.select(item, "field", "wanted", state.alias("state"), "amt")


def release_compare(cur: DataFrame, release: DataFrame, keys: list[str]) -> DataFrame:
    """K3: this push's amount against the release in use."""
    a, b = (d.groupBy(keys).agg(F.sum("amt").alias(n)) for d, n in ((cur, "c"), (release, "r")))
    return join_same(a, b, keys, "full_outer").select(*keys, F.col("c").cast("double").alias("cur_amt"), F.col("r").cast("double").alias("release_amt"), ratio(F.col("c"), F.col("r")).alias("ratio"))


def recheck(df: DataFrame, defects: DataFrame, scope: list[str]) -> DataFrame:
    """K4: every ledger entry evaluated again. An entry holds for rows that agree
    with all of its scope keys (null: any); its value is the mean of ``measure``
    (qty or amt) a row, and it is still present while that is above ``bound``."""
    # the rows are summed to the scope's grain first: what meets the ledger is small
    sums = df.groupBy(scope).agg(F.sum("qty").alias("qty"), F.sum("amt").alias("amt"), F.count("*").alias("rows"))
    agree = F.lit(True)
    for k in scope:
        agree &= F.col(f"d.{k}").isNull() | (F.col(f"s.{k}") == F.col(f"d.{k}"))
    value = F.when(F.col("d.measure") == "qty", F.col("s.qty").cast("double")).otherwise(F.col("s.amt").cast("double"))
    both = defects.alias("d").join(sums.alias("s"), agree, "left").select("d.id", "d.measure", "d.bound", value.alias("v"), "s.rows")
    # whole ten-thousandths, so that the order of summing doesn't matter
    out = both.groupBy("id", "measure", "bound").agg((F.sum(F.floor(F.col("v") * 10000 + 0.5)) / 10000 / F.sum("rows")).alias("v"))
    state = F.when(F.col("v").isNull(), "not evaluable").when(F.col("v") > F.col("bound"), "still present").otherwise("fixed")
    return out.select("id", "measure", state.alias("state"), rounded(F.col("v"), 4).alias("value"))


def promises(ledger: DataFrame, rechecks: DataFrame, month: str) -> DataFrame:
    """K5: promised fixes (id, promised_by): kept, broken or not due in a month."""
    both = ledger.join(rechecks.select("id", "state"), "id", "left")
    due = F.col("promised_by") <= F.lit(month).cast("date")
    return both.select("id", "promised_by", F.when(~due, "not due").when(F.col("state") == "fixed", "kept").otherwise("broken").alias("promise"))


def item_recon(cur_flags: DataFrame, prev_flags: DataFrame, key: list[str]) -> DataFrame:
    """K6: last period's items against this one's: new, open or resolved."""
    a, b = cur_flags.select(key).distinct().withColumn("_c", F.lit(True)), prev_flags.select(key).distinct().withColumn("_p", F.lit(True))
    state = F.when(F.col("_p").isNull(), "new").when(F.col("_c").isNull(), "resolved").otherwise("open")
    return join_same(a, b, key, "full_outer").select(*key, state.alias("state"))


def downgrade(flags: DataFrame, declarations: DataFrame, scope: list[str]) -> DataFrame:
    """K7: flags that a declaration covers (its scope, null for any, and months)
    become ``explained``; others stay ``open``. ``flags`` has a ``month``."""
    agree = F.col("f.month").between(F.col("d.from_month"), F.col("d.to_month"))
    for k in scope:
        agree &= F.col(f"d.{k}").isNull() | (F.col(f"f.{k}") == F.col(f"d.{k}"))
    # what meets the declarations is each place and month once, however many flags it has
    places = flags.select("month", *scope).distinct()
    covered = places.alias("f").join(declarations.alias("d"), agree, "left_semi").withColumn("_on", F.lit(True))
    both = join_same(flags, covered, ["month", *scope], "left")
    return both.select(*flags.columns, F.when(F.col("_on"), "explained").otherwise("open").alias("state"))


def flag_history(flags: DataFrame, ledger: DataFrame, key: list[str]) -> DataFrame:
    """K8: how often a flag was raised before, and first and last when."""
    past = ledger.groupBy(key).agg(F.count("*").alias("times"), F.min("month").alias("first_month"), F.max("month").alias("last_month"))
    return join_same(flags.select(key).distinct(), past, key, "left").select(*key, F.coalesce("times", F.lit(0)).alias("times"), "first_month", "last_month")
