"""H1-H9: the brand layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.components import components
from ..functions.joins import join_same
from ..functions.numeric import ratio, total
from ..functions.text import brand_tokens, folded


def brand_results(df: DataFrame, keys: list[str]) -> DataFrame:
    """H1: items, volume, amount and share of each brand in its key."""
    out = df.groupBy(*keys, "brand").agg(F.count_distinct("item").alias("items"), F.sum("qty").alias("q"), F.sum("amt").alias("a"))
    share = ratio(F.col("a"), F.sum("a").over(Window.partitionBy(keys)))
    return out.select(*keys, "brand", "items", F.col("q").cast("double").alias("qty"), F.col("a").cast("double").alias("amt"), share.alias("share"))


def leaf_brand(df: DataFrame) -> DataFrame:
    """H2: the cube that downstream reads: leaf x brand x amount per month and site."""
    keys = ["month", "country", "platform", "leaf", "brand"]
    return df.groupBy(keys).agg(total("amt").alias("amt"), total("qty").alias("qty"))


def token_amounts(names: DataFrame, name: str = "raw_brand", amount: str = "amt") -> DataFrame:
    """H3 as a table: the parts of brand names, with rows and amount."""
    return names.select(F.explode(brand_tokens(F.col(name))).alias("token"), amount).groupBy("token").agg(F.count("*").alias("rows"), total(amount).alias("amt"))


def brand_variants(names: DataFrame, name: str = "raw_brand", amount: str = "amt") -> DataFrame:
    """H4: spellings that are one name once case, width and kana are folded, with
    the amount of each. ``variant`` is the least spelling of the group."""
    spelt = names.select(F.explode(brand_tokens(F.col(name))).alias("spelling"), amount).groupBy("spelling").agg(F.sum(amount).alias("a"))
    keyed = spelt.withColumn("_k", folded(F.col("spelling")))
    groups = keyed.groupBy("_k").agg(F.min("spelling").alias("variant"), F.count("*").alias("spellings")).where("spellings > 1")
    out = keyed.join(groups, "_k")
    return out.select("variant", "spelling", F.col("spellings").cast("long").alias("spellings"), F.col("a").cast("double").alias("amt"))


def aliases(names: DataFrame, name: str = "raw_brand") -> DataFrame:
    """Pairs of different parts that stand in one name, such as a katakana and a
    Latin form: (token, alias), lowered."""
    parts = F.array_distinct(F.transform(brand_tokens(F.col(name)), lambda t: F.lower(t)))
    listed = names.select(parts.alias("p")).where("size(p) > 1").distinct()
    pairs = listed.select(F.explode("p").alias("token"), "p").select("token", F.explode("p").alias("alias"))
    return pairs.where("token <> alias").distinct()


def families(names: DataFrame, name: str = "raw_brand") -> DataFrame:
    """(token, family): parts of names that stand together in some name, over any
    number of steps, as one family under its least part, lowered. A part that stands
    alone everywhere has no row."""
    return components(aliases(names, name), "token", "alias").select(F.col("node").alias("token"), F.col("component").alias("family"))


def swallowed_families(names: DataFrame, family: DataFrame, raw: str = "raw_brand", standard: str = "brand", amount: str = "amt") -> DataFrame:
    """H5 over chains: raw brands under a standard name of which no part is of one
    family with theirs (``families``). The amount of each pair."""
    apart = swallowed(names, raw, standard, amount)
    each = lambda c, out: apart.select(raw, standard, F.explode(F.array_distinct(F.transform(brand_tokens(F.col(c)), lambda t: F.lower(t)))).alias("token")).join(family, "token").select(raw, standard, F.col("family").alias(out)).distinct()
    mine, theirs = each(raw, "family"), each(standard, "family")
    known = join_same(mine, theirs, [raw, standard, "family"], "left_semi").select(raw, standard).distinct()
    return join_same(apart, known, [raw, standard], "left_anti")


def split_families(names: DataFrame, family: DataFrame, raw: str = "raw_brand", standard: str = "brand", amount: str = "amt") -> DataFrame:
    """H6 over chains: families of raw names that go to several standard names, with
    the share of each. A name of several parts of one family counts once."""
    sums = names.groupBy(raw, standard).agg(F.sum(amount).alias("_a"))
    tokens = sums.select(raw, standard, "_a", F.explode(F.array_distinct(F.transform(brand_tokens(F.col(raw)), lambda t: F.lower(t)))).alias("token"))
    named = tokens.join(family, "token", "left").select(raw, standard, "_a", F.coalesce("family", "token").alias("family")).distinct()
    out = named.groupBy("family", F.col(standard).alias("standard")).agg(F.sum("_a").alias("a"))
    whole = Window.partitionBy("family")
    out = out.withColumns({"n": F.count("*").over(whole), "t": F.sum("a").over(whole)}).where("n > 1")
    return out.select("family", "standard", F.col("n").alias("standards"), ratio(F.col("a"), F.col("t")).alias("share"))


def swallowed(names: DataFrame, raw: str = "raw_brand", standard: str = "brand", amount: str = "amt") -> DataFrame:
    """H5: raw brands put under a standard name with which they share no part, also
    not by an alias or but for one letter. The amount of each pair."""
    pairs = names.groupBy(raw, standard).agg(total(amount).alias("amt"), F.count("*").alias("rows"))
    lowered = lambda c: F.transform(brand_tokens(F.col(c)), lambda t: F.lower(t))
    pairs = pairs.withColumns({"_r": lowered(raw), "_s": lowered(standard)})
    close = F.exists("_r", lambda a: F.exists("_s", lambda b: (F.length(a) >= 4) & (F.levenshtein(a, b) <= 1)))
    apart = pairs.where(~F.arrays_overlap("_r", "_s") & ~close)
    # parts of both names that stand together in some raw name; a row for each pair of parts
    asked = apart.select(raw, standard, F.explode("_r").alias("token"), "_s").select(raw, standard, "token", F.explode("_s").alias("alias"))
    known = asked.join(aliases(names, raw), ["token", "alias"], "left_semi").select(raw, standard).distinct()
    return join_same(apart, known, [raw, standard], "left_anti").select(raw, standard, "rows", "amt")


def split_brands(names: DataFrame, raw: str = "raw_brand", standard: str = "brand", amount: str = "amt") -> DataFrame:
    """H6: parts of raw names that go to several standard names, with the share of
    each."""
    parts = names.select(F.explode(F.array_distinct(F.transform(brand_tokens(F.col(raw)), lambda t: F.lower(t)))).alias("token"), F.col(standard).alias("standard"), F.col(amount).alias("_a"))
    out = parts.groupBy("token", "standard").agg(F.sum("_a").alias("a"))
    whole = Window.partitionBy("token")
    out = out.withColumns({"n": F.count("*").over(whole), "t": F.sum("a").over(whole)}).where("n > 1")
    return out.select("token", "standard", F.col("n").alias("standards"), ratio(F.col("a"), F.col("t")).alias("share"))


def non_brand(names: DataFrame, words: DataFrame, name: str = "raw_brand", amount: str = "amt") -> DataFrame:
    """H7: names that are no brand: a listed word, digits only, or blank."""
    listed = words.select(F.lower("word").alias("_w")).distinct().withColumn("_on", F.lit(True))
    out = names.withColumn("_n", F.trim(F.coalesce(F.col(name), F.lit("")))).join(listed, F.lower("_n") == F.col("_w"), "left")
    kind = F.when(F.col("_n") == "", "blank").when(F.col("_n").rlike("^[0-9]+$"), "digits").when(F.col("_on"), "word")
    return out.withColumn("kind", kind).where("kind IS NOT NULL").groupBy(F.col("_n").alias("name"), "kind").agg(F.count("*").alias("rows"), total(amount).alias("amt"))


def others_yoy(df: DataFrame, keys: list[str], label: str = "OTHERS") -> DataFrame:
    """H8: the share of the bucket brand in a key's amount, and its change from the
    same month of last year (null where that is absent)."""
    sums = df.groupBy("month", *keys).agg(F.sum(F.when(F.col("brand") == label, F.col("amt"))).alias("o"), F.sum("amt").alias("a"))
    share = F.coalesce(F.col("o"), F.lit(0).cast("decimal(20,4)")).cast("double") / F.col("a").cast("double")
    now = sums.where("a <> 0").select("month", *keys, share.alias("_s"))
    then = now.select(F.add_months("month", 12).alias("month"), *keys, F.col("_s").alias("_t"))
    to = lambda c: F.floor(c * 1000000 + 0.5) / 1000000
    return join_same(now, then, ["month", *keys], "left").select("month", *keys, to(F.col("_s")).alias("share"), to(F.col("_t")).alias("last_year"), to(F.col("_s") - F.col("_t")).alias("change"))


def leaf_top_brands(df: DataFrame, leaf: str, month: str, base_month: str, n: int = 5) -> DataFrame:
    """H9: the top n brands of each leaf, with share, and rank in the base month."""

    def ranked(m: str) -> DataFrame:
        sums = df.where(F.col("month") == F.lit(m).cast("date")).groupBy(leaf, "brand").agg(F.sum("amt").alias("a"))
        return sums.withColumn("rank", F.row_number().over(Window.partitionBy(leaf).orderBy(F.desc("a"), "brand")))

    whole = df.where(F.col("month") == F.lit(month).cast("date")).groupBy(leaf).agg(F.sum("amt").alias("t"))
    now = join_same(ranked(month).where(F.col("rank") <= n), whole, [leaf])
    then = ranked(base_month).select(leaf, "brand", F.col("rank").alias("base_rank"))
    return join_same(now, then, [leaf, "brand"], "left").select(leaf, "brand", "rank", "base_rank", ratio(F.col("a"), F.col("t")).alias("share"))
