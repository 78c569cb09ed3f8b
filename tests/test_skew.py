"""One key that holds a third of all rows: same results, and no task holds the key whole."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import driver_oracle
import driver_queries
from compare import TABLES, connect, duck_rows, spark_rows
from daylake import operators as ops

# A status table with a hot order is laid out in `test_hot_order_is_cut_into_pieces`, where only
# one step is hot: with four hot steps the result itself is the product of four large sets.
PRODUCTS = {"order_statuses", "order_statuses_one_pass", "order_status_funnel"}


@pytest.fixture(scope="module")
def skewed(small, tmp_path_factory):
    """The small tables with a third of the lines in one order, bought from one supplier, a
    third of the orders at one customer, and a third of the lines copies of one line."""
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM '{small}/{name}.parquet'")
    con.execute("UPDATE orders SET o_custkey = 7 WHERE o_orderkey % 3 = 0")
    con.execute("CREATE TABLE n AS SELECT *, row_number() OVER (ORDER BY l_orderkey, l_partkey, l_extendedprice) AS i FROM lineitem")
    con.execute("UPDATE n SET l_orderkey = 5, l_suppkey = CASE WHEN i % 2 = 0 THEN 3 ELSE l_suppkey END WHERE i % 3 = 0")
    con.execute("""CREATE OR REPLACE TABLE lineitem AS
        SELECT * EXCLUDE (i) FROM n UNION ALL
        SELECT first.* EXCLUDE (i) FROM n CROSS JOIN (SELECT * FROM n WHERE i = 3) first WHERE n.i % 3 = 1""")
    for name in TABLES:
        con.execute(f"COPY {name} TO '{out / name}.parquet' (FORMAT parquet)")
    return str(out)


@pytest.mark.parametrize("name", [n for n in driver_oracle.ORACLE if n not in PRODUCTS])
def test_skewed_tables_match_sql(spark, skewed, name):
    df = driver_queries.QUERIES[name](spark, skewed)
    columns, expected = duck_rows(connect(skewed), driver_oracle.ORACLE[name])
    assert sorted(columns) == sorted(df.columns)
    assert spark_rows(df) == expected


def history(spark, hot_step, rows=900):
    """A hot order with `rows` entries of one step, each twice, and a few of the others."""
    hot = spark.range(rows).select(
        F.lit(1).alias("order_id"), F.lit(hot_step).alias("status_value"), F.col("id").alias("status_created_at")
    )
    rest = spark.range(1200).select(
        (F.col("id") % 100).alias("order_id"),
        F.get(F.array(*[F.lit(s) for s in ("REGISTERED", "PLACED", "CONCLUDED", "CANCELLED", "AO")]), (F.col("id") % 7 % 5).cast("int")).alias("status_value"),
        (F.col("id") % 13).alias("status_created_at"),
    )
    # Other orders have all steps; the hot one has one entry in each step but the hot one.
    few = spark.createDataFrame([(1, s, 5) for s in ("REGISTERED", "PLACED", "CANCELLED")], "order_id long, status_value string, status_created_at long")
    return hot.union(hot).union(rest.filter("order_id != 1")).union(few)


@pytest.mark.parametrize("chained", [False, True])
@pytest.mark.parametrize("hot_step", ["REGISTERED", "PLACED", "CONCLUDED", "CANCELLED"])
def test_hot_order_is_cut_into_pieces(spark, hot_step, chained):
    status = history(spark, hot_step)
    orders = spark.range(120).select(F.col("id").alias("order_id"))
    con = duckdb.connect()
    con.register("status", status.toPandas())
    con.register("ord", orders.toPandas())
    sql = (driver_oracle.FUNNEL if chained else driver_oracle.FOUR_JOINS).split("FROM lineitem)")[-1]
    _, expected = duck_rows(con, sql)
    assert max(expected.values()) == 1
    for options in (
        {"gather": False, "hot_rows": 100},
        {"gather": False},
        {"hot_rows": 100},
        {},
    ):
        got = ops.status_table(orders, status, chained=chained, **options)
        assert spark_rows(got) == expected


def test_no_task_gets_the_hot_order_whole(spark):
    status = history(spark, "PLACED")
    orders = spark.range(120).select(F.col("id").alias("order_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        got = ops.status_table(orders, status, hot_rows=100)
        per_task = got.filter("order_id = 1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(per_task) > 1


def test_all_steps_share_one_shuffle_of_the_status_table(spark, tmp_path):
    path = str(tmp_path / "status")
    history(spark, "PLACED").write.parquet(path)
    orders = spark.range(120).select(F.col("id").alias("order_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = ops.status_table(orders, spark.read.parquet(path), gather=False)
        got.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Each of the four steps reads the one shuffle: either the first of them makes it, or the list of hot orders has.
    scans = final.count("FileScan parquet")
    assert scans <= 1 and scans + final.count("ReusedExchange") == 4
