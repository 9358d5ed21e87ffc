"""The wide sales table: its schema, reading it, and the view of the test tables.

Grain: item x site (country, platform) x month. Money is decimal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.freeze import row_hash
from .database import SalesDatabase

SITE = ["country", "platform"]
LABELS = ["root", "node", "l1", "l2", "leaf", "raw_brand", "brand", "list_price"]

SALES = T.StructType([
    T.StructField("month", T.DateType()),
    T.StructField("country", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("root", T.IntegerType()),
    T.StructField("node", T.IntegerType()),
    T.StructField("l1", T.StringType()),
    T.StructField("l2", T.StringType()),
    T.StructField("leaf", T.StringType()),
    T.StructField("item", T.LongType()),
    T.StructField("raw_brand", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("list_price", T.DecimalType(18, 2)),
    T.StructField("qty", T.DecimalType(18, 2)),
    T.StructField("amt", T.DecimalType(20, 4)),
])


def load_sales(spark: SparkSession, source: str | dict) -> DataFrame:
    """A1: the whole table, all sites and months, cast to the declared schema.

    ``source`` is a path of Parquet, options of a read by a Python driver
    (``sources.database``, a partition a month), or options of a JDBC read (give
    ``partitionColumn`` and ``numPartitions``, so that months load in parallel).
    A missing column is an error.
    """
    if isinstance(source, str):
        return typed(spark.read.parquet(source))
    if "driver" in source and "url" not in source:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
        spark.dataSource.register(SalesDatabase)
        return spark.read.format(SalesDatabase.name()).options(**source).load()
    return typed(spark.read.format("jdbc").options(**source).load())


def typed(raw: DataFrame) -> DataFrame:
    return raw.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in SALES.fields))


def sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales rows that the order tables hold, in the declared schema, dealt by item.

    Orders get their site first and lines are joined narrow, so a line travels twice: to
    its order and to its item. The labels are put on where it then is, so whatever groups
    by items and more (a base, prices, labels) shuffles nothing again.
    """
    t = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("lineitem", "orders", "customer", "nation", "region", "part")}
    places = (
        t["orders"]
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", "r_name", "c_mktsegment")
    )
    lines = t["lineitem"].select("l_orderkey", "l_partkey", F.trunc("l_shipdate", "MM").alias("month"), "l_quantity", "l_extendedprice", "l_discount")
    # the same plan whatever the sizes: no side is broadcast in one and shuffled in another
    joined = lines.join(places.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).join(t["part"].hint("merge"), F.col("l_partkey") == F.col("p_partkey"))
    first, second = (F.split_part("p_name", F.lit(" "), F.lit(k)) for k in (1, 2))
    money = F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return typed(
        joined.select(
            "month",
            F.col("r_name").alias("country"),
            F.col("c_mktsegment").alias("platform"),
            F.floor(F.col("p_size") / 10).cast("int").alias("root"),
            F.col("p_size").alias("node"),
            F.col("p_type").alias("l1"),
            F.concat("p_type", F.lit("/"), second).alias("l2"),
            F.concat("p_type", F.lit("/"), second, F.lit("/"), first).alias("leaf"),
            F.col("p_partkey").alias("item"),
            first.alias("raw_brand"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").alias("list_price"),
            F.col("l_quantity").alias("qty"),
            money.alias("amt"),
        )
    )


_CURRENT = "item % 29 <> 0"
_PREVIOUS = "item % 23 <> 0 AND month < DATE'{last}'"


def current_push(w: DataFrame) -> DataFrame:
    """The push under review, for tests: without every 29th item."""
    return w.where(_CURRENT)


def previous_rows(w: DataFrame, last: str = "2001-11-01") -> DataFrame:
    """The rows that the push before it had, as they are now."""
    return w.where(_PREVIOUS.format(last=last))


def _moved() -> dict[str, Column]:
    return {
        "root": F.when(F.col("node").isin(40, 41), 9).otherwise(F.col("root")),
        "l2": F.when(F.col("item") % 31 == 0, F.concat("l1", F.lit("/moved"))).otherwise(F.col("l2")),
        "brand": F.when(F.col("item") % 37 == 0, F.lit("OTHERS")).otherwise(F.col("brand")),
        "qty": (F.col("qty") + F.when(F.col("item") % 17 == 0, 1).otherwise(0)).cast("decimal(18,2)"),
    }


def previous_push(w: DataFrame, last: str = "2001-11-01") -> DataFrame:
    """The push before it, for tests: a month shorter, with other items, volumes,
    labels, brands and a node moved."""
    return previous_rows(w, last).withColumns(_moved())


def both_pushes(w: DataFrame, last: str = "2001-11-01") -> DataFrame:
    """The rows of both pushes in one pass, marked ``current`` or ``previous`` in
    ``push``; a row that both have is there twice."""
    of = F.array_compact(F.array(F.when(F.expr(_CURRENT), "current"), F.when(F.expr(_PREVIOUS.format(last=last)), "previous")))
    then = F.col("push") == "previous"
    return w.withColumn("push", F.explode(of)).withColumns({c: F.when(then, v).otherwise(F.col(c)) for c, v in _moved().items()})


def base(sales: DataFrame, checks: bool = False) -> DataFrame:
    """Volume and amount per month, site, item and its labels: where most
    operators start. Persist or freeze it once for a run. With ``checks`` it also
    carries the rows and the checksum of what went in, so that a month's can be told
    without reading the source again."""
    more = [F.count("*").alias("rows"), F.sum(row_hash(sales)).alias("checksum")] if checks else []
    return sales.groupBy("month", *SITE, "item", *LABELS).agg(F.sum("qty").alias("qty"), F.sum("amt").alias("amt"), *more)
