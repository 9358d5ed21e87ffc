"""M1-M4, M6: flags by fixed rules, digests, impact, drill-down, acceptance.

Results of modules come as long tables: module, key, metric, value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.joins import join_same
from ..functions.numeric import ratio
from ..sources.scratch import written


def long_results(df: DataFrame, module: str, key: list[str], metrics: list[str]) -> DataFrame:
    """A module's result as rows of module, key (``functions.keys``), metric and value."""
    named = df.select(keys.key_text(*key).alias("key"), *(F.col(m).cast("double").alias(m) for m in metrics))
    return named.unpivot("key", metrics, "metric", "value").select(F.lit(module).alias("module"), "key", "metric", "value")


def screen(results: DataFrame, rules: DataFrame) -> DataFrame:
    """M1: results outside the rules (metric, low, high, rule, severity)."""
    both = results.where("value IS NOT NULL").join(rules, "metric")
    return both.where((F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))).select("module", "key", "metric", "value", "rule", "severity")


def digest(flags: DataFrame, n: int, amount: str = "amt") -> DataFrame:
    """M2: per module the number of flags, their amount, and the top n by amount."""
    whole = Window.partitionBy("module")
    order = whole.orderBy(F.desc(amount), "key", "metric")
    sums = flags.groupBy("module").agg(F.count("*").alias("flags"), F.sum(F.col(amount).cast("decimal(38,4)")).cast("double").alias("module_amt"))
    top = flags.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return top.join(sums, "module").select("module", "flags", "module_amt", "rank", "key", "metric", F.col(amount).cast("double").alias("amt"))


def impact(df: DataFrame, flags: DataFrame, key: list[str]) -> DataFrame:
    """M3: the distinct amount that a set of flags touches; overlaps count once."""
    touched = join_same(df, flags.select(key).distinct(), key, "left_semi").agg(F.sum("amt").alias("t"), F.count("*").alias("n"))
    whole = df.agg(F.sum("amt").alias("a"))
    # one row by one row
    return touched.crossJoin(whole).select(F.col("n").alias("rows"), F.coalesce("t", F.lit(0)).cast("double").alias("touched"), ratio(F.coalesce("t", F.lit(0)), F.col("a")).alias("share"))


def impact_of_grains(df: DataFrame, flags: DataFrame, by: list[str]) -> DataFrame:
    """M3 for flags of any grains (``key`` as ``long_results`` has it): per ``by`` the
    rows and the amount that any of them is about, each row once, and its share."""
    t = keys.touched(df, flags)
    hit = F.when(F.col("touched"), F.col("amt"))
    sums = t.groupBy(by).agg(F.count_if("touched").alias("rows"), F.coalesce(F.sum(hit), F.lit(0)).alias("t"), F.sum("amt").alias("a"))
    return sums.select(*by, "rows", F.col("t").cast("double").alias("touched"), ratio(F.col("t"), F.col("a")).alias("share"))


def module_impact(df: DataFrame, flags: DataFrame, by: list[str]) -> DataFrame:
    """M3 per module (a column of ``flags``) and ``by``: rows and amount (decimal) that
    the module's flags are about, each row once."""
    rows = keys.touching(df, flags, "module").select(*by, "amt", F.explode("touching").alias("module"))
    return rows.groupBy("module", *by).agg(F.count("*").alias("rows"), F.sum("amt").alias("amt"))


def drill(df: DataFrame, flag: dict, month: str, base_month: str, n: int = 20) -> DataFrame:
    """M4: the items behind a flag (values of columns, None for null), by how much
    they moved."""
    for k, v in flag.items():
        df = df.where(F.col(k).eqNullSafe(F.lit(v)))
    side = lambda m, s: df.where(F.col("month") == F.lit(m).cast("date")).groupBy("item").agg(F.sum("amt").alias(s))
    zero = F.lit(0).cast("decimal(20,4)")
    both = join_same(side(month, "a1"), side(base_month, "a0"), ["item"], "full_outer").withColumn("d", F.coalesce("a1", zero) - F.coalesce("a0", zero))
    top = both.orderBy(F.desc(F.abs("d")), "item").limit(n)
    return top.select("item", F.col("a0").cast("double").alias("base_amt"), F.col("a1").cast("double").alias("amt"), F.col("d").cast("double").alias("change"))


def drill_flags(df: DataFrame, flags: DataFrame, month: str, months: int = 1, n: int = 20) -> DataFrame:
    """M4 for all flags at once: per key, its first n items by how much they moved
    against ``months`` before. A key that names a month is looked at in that month,
    others in ``month``. Flags that share a key share its items.
    """
    zero = F.lit(0).cast("decimal(20,4)")
    out = []
    flags = written(flags.select("key").distinct(), "flags")
    for names in keys.grains(flags):
        flag = keys.of_grain(flags, names, df)
        at = [k for k in names if k != "month"]
        flag = flag.select("key", *at, (F.col("month") if "month" in names else F.lit(month).cast("date")).alias("_m"))
        # what meets the flags is summed to their grain and item first; a row counts for
        # its own month and, as the month before, for a later one
        sums = df.groupBy("month", *{*at, "item"}).agg(F.sum("amt").alias("_a"))
        side = [F.struct(F.col("month").alias("_m"), F.lit(True).alias("_now")), F.struct(F.add_months("month", months).alias("_m"), F.lit(False).alias("_now"))]
        sums = sums.withColumn("_s", F.explode(F.array(*side))).select(*{*at, "item"}, "_a", "_s.*")
        out.append(join_same(sums, keys.short(flag), [*at, "_m"]).select("key", "item", "_a", "_now"))
    if not out:
        return flags.select("key", F.lit(0).alias("rank"), F.lit(None).cast(df.schema["item"].dataType).alias("item"), *(F.lit(0.0).alias(c) for c in ("base_amt", "amt", "change"))).where("false")
    rows = reduce(DataFrame.unionByName, out).groupBy("key", "item").agg(F.sum(F.when(~F.col("_now"), F.col("_a"))).alias("a0"), F.sum(F.when(F.col("_now"), F.col("_a"))).alias("a1"))
    rows = rows.withColumn("d", F.coalesce("a1", zero) - F.coalesce("a0", zero))
    order = Window.partitionBy("key").orderBy(F.desc(F.abs("d")), "item")
    top = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return top.select("key", "rank", "item", F.col("a0").cast("double").alias("base_amt"), F.col("a1").cast("double").alias("amt"), F.col("d").cast("double").alias("change"))


def flag_amounts(df: DataFrame, flags: DataFrame, amount: str = "amt") -> DataFrame:
    """(key, amt): what each distinct key is about, summed."""
    out = [flags.select("key", F.lit(None).cast("decimal(38,4)").alias("_a")).where("false")]
    for names in keys.grains(flags):
        sums = df.groupBy(names).agg(F.sum(amount).alias("_a"))
        out.append(join_same(keys.of_grain(flags.select("key").distinct(), names, df), sums, names, "left").select("key", "_a"))
    return reduce(DataFrame.unionByName, out).select("key", F.coalesce("_a", F.lit(0)).alias("amt"))


def module_acceptance(df: DataFrame, flags: DataFrame, site: list[str], modules: list[str], unchecked: list[str]) -> DataFrame:
    """M6 for flags of any grains: each module x site of ``df``, with how many flags are
    about rows of the site and the share of its amount that they touch, once.

    ``flags``: module, key, state. Modules in ``unchecked`` say so where they have no flag.
    """
    spark = df.sparkSession
    seen = [flags.select("module", "key", "state", *(F.lit(None).cast(df.schema[c].dataType).alias(c) for c in site)).where("false")]
    for names in keys.grains(flags):
        places = df.select(*{*names, *site}).distinct()
        flag = keys.of_grain(flags.select("module", "key", "state").distinct(), names, df)
        seen.append(join_same(places, flag, names).select("module", "key", "state", *site).distinct())
    counts = reduce(DataFrame.unionByName, seen).groupBy("module", *site).agg(F.count("*").alias("flags"), F.count_if(F.col("state") == "open").alias("open"))
    # twelve modules by sites
    listed = spark.createDataFrame([(m, m in unchecked) for m in modules], "module string, _unchecked boolean")
    totals = df.groupBy(site).agg(F.sum("amt").alias("total_amt"))
    both = join_same(listed.crossJoin(totals), counts, ["module", *site], "left")
    both = join_same(both, module_impact(df, flags, site), ["module", *site], "left")
    status = F.when(F.col("open") > 0, "fail").when(F.col("flags") > 0, "explained").when(F.col("_unchecked"), "not checked").otherwise("pass")
    return both.select("module", *site, status.alias("status"), F.coalesce("flags", F.lit(0)).alias("flags"), ratio(F.coalesce("amt", F.lit(0)), F.col("total_amt")).alias("share"))


def acceptance(flags: DataFrame, totals: DataFrame, site: list[str]) -> DataFrame:
    """M6: module x site: fail with an open flag, explained if all are, else pass.

    ``flags``: module, site, state, amt; ``totals``: site, total_amt. Every module
    gets every site.
    """
    grid = flags.select("module").distinct().crossJoin(totals)  # modules by sites
    n = flags.groupBy("module", *site).agg(F.count("*").alias("flags"), F.count_if(F.col("state") == "open").alias("open"), F.sum("amt").alias("a"))
    both = join_same(grid, n, ["module", *site], "left")
    status = F.when(F.col("open") > 0, "fail").when(F.col("flags") > 0, "explained").otherwise("pass")
    return both.select("module", *site, status.alias("status"), F.coalesce("flags", F.lit(0)).alias("flags"), ratio(F.coalesce("a", F.lit(0)), F.col("total_amt")).alias("share"))
