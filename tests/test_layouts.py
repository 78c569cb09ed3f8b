"""Co-located tables, distinct counts by bitmap, and hot keys by sketch."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

import driver_oracle
import driver_queries
import driver_tables as t
from daylake import operators as ops
from daylake import plans
from daylake.operators.quality import distinct_values, profile
from daylake.operators.skew import hot_items
from daylake.sources.buckets import create_colocated, layout, read_colocated, write_colocated

D1, D2 = dt.date(2020, 7, 18), dt.date(2020, 7, 19)


def initial(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def final(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture()
def database(spark):
    name = f"d{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_join_of_colocated_tables_has_no_shuffle(spark, small, tmp_path, database, no_broadcast):
    plans.publish_colocated(t.orders(spark, small), t.status(spark, small), str(tmp_path), D1, 6, database)
    joined = plans.orders_with_last_status(spark, D1, database)
    text = final(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    # Grouping by the key, or by more than it, needs none either.
    for keys in (["order_id"], ["order_id", "status_value"]):
        assert "Exchange" not in final(joined.groupBy(*keys).count())


def test_days_of_a_colocated_table(spark, tmp_path, database):
    table, path = f"{database}.t", str(tmp_path / "t")
    rows = spark.range(100).select("id", (F.col("id") % 7).alias("value"))
    write_colocated(rows, table, path, D1, "id", 4)
    write_colocated(rows.filter("id < 30"), table, path, D2, "id", 4)
    write_colocated(rows.filter("id < 50"), table, path, D1, "id", 4)
    assert (read_colocated(spark, table, D1).count(), read_colocated(spark, table, D2).count()) == (50, 30)
    assert layout(spark, table) == ("id", 4)
    assert len(list((tmp_path / "t" / f"partition={D1}").glob("*.parquet"))) == 4
    for key, buckets in (("id", 8), ("value", 4)):
        with pytest.raises(ValueError):
            create_colocated(spark, table, path, rows, key, buckets)


@pytest.mark.parametrize("dense", [False, True])
def test_distinct_counts(spark, dense):
    values = [None, 0, -1, 1, 5, 5, 32_767, 32_768, -32_768, 1 << 40, -(1 << 40), (1 << 63) - 1, -(1 << 63)]
    df = spark.createDataFrame([(v,) for v in values] * 3, "k long").repartition(4)
    assert distinct_values(df, "k", dense).collect() == [(11,)]
    assert distinct_values(df.filter("k IS NULL"), "k", dense).collect() == [(0,)]
    assert distinct_values(df.limit(0), "k", dense).collect() == [(0,)]


def test_profile_copies_no_row(spark, small):
    df = driver_queries.table_profile(spark, small)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text and text.count("bitmap_construct_agg") >= 2
    assert profile(spark.range(10), ["id"]).collect() == [(10, 10)]
    with pytest.raises(ValueError):
        profile(t.table(spark, small, "part"), ["p_name"], dense=["p_name"])


def test_hot_items_are_found_whatever_else_there_is(spark):
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit("warm")).otherwise(F.concat(F.lit("k"), "id")).alias("k")
    )
    got = {r.item: r.rows for r in hot_items(rows, F.col("k"), 3_000).collect()}
    assert set(got) == {"hot", "warm"}
    assert got["hot"] == pytest.approx(133_334, rel=0.05) and got["warm"] == pytest.approx(5_333, rel=0.2)
    assert hot_items(rows.limit(0), F.col("k"), 1).count() == 0


@pytest.mark.parametrize("name", ["order_statuses", "order_statuses_one_pass", "order_status_funnel"])
def test_status_tables_scan_at_most_twice_as_often_as_four_joins(spark, small, name):
    for table in ("orders", "lineitem"):
        spark.read.parquet(f"{small}/{table}.parquet").createOrReplaceTempView(table)
    status = t.status(spark, small)
    literal = t.orders(spark, small)
    for k, step in enumerate(ops.statuses.STEPS):
        one = status.filter(F.col("status_value") == step).withColumnRenamed("status_created_at", f"at_{k}")
        literal = literal.join(one.drop("status_value"), "order_id", "left")
    limit = 2 * initial(literal.select("order_id", *[f"at_{k}" for k in range(4)]).distinct()).count("FileScan")
    assert initial(driver_queries.QUERIES[name](spark, small)).count("FileScan") <= limit
    assert name in driver_oracle.ORACLE


def test_steps_out_of_reach_do_not_lose_a_hot_order(spark):
    """In a chain the hot step may come after one that the order never reached."""
    hot = spark.range(500).select(F.lit(1).alias("order_id"), F.lit("PLACED").alias("status_value"), F.col("id").alias("status_created_at"))
    first = spark.createDataFrame([(1, "REGISTERED", 5), (2, "REGISTERED", 6), (3, "PLACED", 7)], "order_id long, status_value string, status_created_at long")
    skipped = hot.withColumn("status_value", F.lit("CONCLUDED")).union(first)
    orders = spark.range(4).withColumnRenamed("id", "order_id")
    for gather in (True, False):
        got = ops.status_funnel(orders, skipped, gather=gather, hot_rows=100).collect()
        assert sorted((r.order_id, r.status_created_at_1, r.status_created_at_2) for r in got) == [(1, 5, None), (2, 6, None)]
        assert ops.status_funnel(orders, hot.union(first), gather=gather, hot_rows=100).count() == 501
        assert ops.status_table(orders, hot.union(first), gather=gather, hot_rows=100).count() == 503
