"""The order model derived from the driver's star-schema tables."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import driver_documents
from daylake.operators.skew import HOT_ROWS, hot_items

# Workers get the module with the function, wherever the driver has it.
cloudpickle.register_pickle_by_value(driver_documents)

# Line flag and status to order status; other pairs keep their own letters.
STATUS_NAMES = {"AF": "REGISTERED", "NF": "PLACED", "NO": "CONCLUDED", "RF": "CANCELLED"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; the merchant is the least supplier of the lines, null for an order without lines."""
    merchant = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_suppkey").alias("merchant_id"))
    )
    return (
        table(spark, sf_dir, "orders")
        .join(merchant, "o_orderkey", "left")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            "merchant_id",
            F.col("o_orderdate").alias("order_created_at"),
            F.concat(
                F.lit(" "), F.lpad(F.col("o_custkey").cast("string"), 11, "0"), F.lit(" ")
            ).alias("cpf"),
            "o_totalprice",
        )
    )


def consumers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.right("c_name", F.lit(9)).alias("customer_phone_number"),
        "c_mktsegment",
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), "s_name", "s_nationkey"
    )


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.concat("l_returnflag", "l_linestatus")
    for (flag, line), name in STATUS_NAMES.items():
        is_pair = (F.col("l_returnflag") == flag) & (F.col("l_linestatus") == line)
        value = F.when(is_pair, F.lit(name)).otherwise(value)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        value.alias("status_value"),
        F.col("l_shipdate").alias("status_created_at"),
    )


def _hundredths(c: Column | str) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) * 100).cast("bigint")


#: What the lines of one order, brand, number and state add up to.
SUMS = {
    "n": F.sum, "quantity": F.sum, "partkey": F.min, "suppkey": F.min, "p_name": F.min, "flag": F.min,
    "least_status": F.min, "greatest_status": F.max, "tax": F.sum, "discount": F.sum, "retail": F.min,
    "unit": F.max, "price": F.sum,
}

#: Lines for which a task is worth starting, and lines that a task takes once there are as many tasks as the
#: session has shuffle partitions. A line becomes some 550 bytes of text, so bytes shuffled say little of the work.
LEAST_LINES, MOST_LINES = 20_000, 500_000


def _tasks(lines: DataFrame) -> int:
    count, usual = lines.count(), int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, min(usual, count // LEAST_LINES), count // MOST_LINES)


def carts(spark: SparkSession, sf_dir: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Item documents of each order: an item per brand, and in it a garnish per number of lines not returned.

    A batch of orders at a time is cut into items and garnishes, and written as text, over Arrow columns.
    """
    return _gathered(spark, sf_dir, hot_rows).select("order_id", _documents("lines").alias("items"))


def orders_with_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` with their documents, null for an order without lines. Orders meet the lines where these are gathered,
    before they become text: Spark does not know how rows that Python made are dealt out, and would shuffle the text."""
    found = orders(spark, sf_dir)
    lines = _gathered(spark, sf_dir, HOT_ROWS)
    joined = found.join(lines, "order_id", "left").withColumn("known", F.col("lines").isNotNull())
    some = F.coalesce("lines", F.array().cast(lines.schema["lines"].dataType))
    return joined.select(*found.columns, F.when(F.col("known"), _documents(some)).alias("items"))


def _documents(lines: Column | str) -> Column:
    return F.arrow_udf(driver_documents.documents, T.StringType())(lines)


def _gathered(spark: SparkSession, sf_dir: str, hot_rows: int) -> DataFrame:
    """The lines of each order, gathered in one shuffle and sorted.

    Lines of orders that a sketch finds to have more than `hot_rows` are first summed up by order, brand, number
    and state. There are seven line numbers and 25 brands, so those documents stay small however many lines an
    order has, and no task receives its lines one by one.
    """
    kept = F.col("l_returnflag") != "R"
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("p_brand").alias("name"),
        F.col("l_linenumber").alias("number"),
        kept.alias("kept"),
        F.lit(1).cast("bigint").alias("n"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"),
        "p_name",
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("least_status"),
        F.col("l_linestatus").alias("greatest_status"),
        _hundredths("l_tax").alias("tax"),
        _hundredths("l_discount").alias("discount"),
        _hundredths("p_retailprice").alias("retail"),
        _hundredths("l_extendedprice").alias("unit"),
        _hundredths("l_extendedprice").alias("price"),
    )
    # Lines without an order are those of one; -1 stands for it here, whatever else has that number.
    hot = hot_items(lines, F.coalesce("l_orderkey", F.lit(-1)), hot_rows)
    if not hot.isEmpty():
        known = F.broadcast(hot.select(F.col("item").alias("__hot")))
        of_hot = F.coalesce("order_id", F.lit(-1)) == F.col("__hot")
        summed = joined.join(known, of_hot, "left_semi").groupBy("order_id", "name", "number", "kept")
        joined = joined.join(known, of_hot, "left_anti").unionByName(
            summed.agg(*[f(c).alias(c) for c, f in SUMS.items()])
        )
    # The struct is made before the shuffle: within the aggregate it would be interpreted, line by line.
    line = F.struct("name", "number", "kept", *SUMS).alias("line")
    gathered = joined.select("order_id", line).repartition(_tasks(lines), "order_id").groupBy("order_id")
    return gathered.agg(F.sort_array(F.collect_list("line")).alias("lines"))
