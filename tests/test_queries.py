"""Every registered query against its SQL, and the plans behind them."""

from __future__ import annotations

import pytest

from compare import connect, duck_rows, spark_rows

import __spark_entry__ as contract
import driver_oracle
import driver_queries
from daylake.operators import order_items
from driver_tables import carts

QUERIES = driver_queries.QUERIES
ORACLE = driver_oracle.ORACLE


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    rows = spark_rows(df)
    if name not in ORACLE:
        assert rows
        return
    columns, expected = duck_rows(duck, ORACLE[name])
    assert sorted(columns) == sorted(df.columns)
    assert rows == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


READ_ONLY = [n for n in QUERIES if not n.startswith(("gated", "raw_", "csv", "json", "parquet", "partition"))]


@pytest.mark.parametrize("name", READ_ONLY)
def test_plans_stay_in_the_jvm(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for word in ("PythonUDF", "EvalPython", "MapInPandas", "Scan ExistingRDD", "CartesianProduct", "NestedLoop"):
        assert word not in text


@pytest.mark.parametrize("name", ["latest_order_per_customer", "latest_status_per_order", "trusted_order"])
def test_newest_row_is_limited_before_the_shuffle(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


def test_filters_and_columns_reach_the_scan(spark, small):
    text = plan(spark.read.parquet(f"{small}/events.parquet").filter("event_type = 'click'").select("event_id"))
    assert "EqualTo(event_type,click)" in text and "ReadSchema: struct<event_id:bigint,event_type:string>" in text


@pytest.mark.parametrize("name", ["items_parsed", "item_detail", "garnish_detail", "order_items"])
def test_documents_are_parsed_in_one_place(spark, small, name):
    assert "size(from_json" not in plan(QUERIES[name](spark, small))


def test_join_of_items_reads_and_parses_documents_once(spark, small, tmp_path):
    carts(spark, small).write.parquet(str(tmp_path / "cart"))
    joined = order_items(spark.read.parquet(str(tmp_path / "cart")), always_join=True)
    joined.collect()
    final = plan(joined).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and final.count("from_json") == 1 and final.count("ReusedExchange") == 1
