"""Wide orders: those that cannot be chosen are dropped before a shuffle, and documents are not shuffled as text."""

from __future__ import annotations

import datetime as dt
import random

import driver_queries
import driver_tables
import pytest
from daylake import operators as ops
from daylake import plans
from daylake.plans import jobs
from test_carts import tables

DAY = dt.date(2024, 1, 31)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def wide_rows(spark, rows=3_000):
    draw = random.Random(5)
    made = [
        (draw.choice([None, *range(300)]), draw.choice([None, 0.0, -0.0, 1.0, float("nan")]), draw.randrange(4), f"text {k % 7}")
        for k in range(rows)
    ]
    return spark.createDataFrame(made, "k int, t double, id int, items string").repartition(5)


@pytest.mark.parametrize("words", [1, 64, 1 << 20])
def test_dropped_rows_are_none_that_could_be_chosen(spark, words):
    df = wide_rows(spark)
    kept = ops.may_be_latest(df, df, "k", "t", ["id"], words)
    chosen = ops.latest(df, "k", "t", ["id"])

    def rows(some):
        # Both zeros are equal, so either may be chosen.
        return sorted(repr(r).replace("-0.0", "0.0") for r in some.collect())

    assert rows(ops.latest(kept, "k", "t", ["id"])) == rows(chosen)
    assert kept.select("k", "t", "id").distinct().count() >= chosen.count() == 301
    if words > 64:
        # Few others stay: rows that tie with the chosen one do.
        assert kept.select("k", "t", "id").distinct().count() < 2 * 301 < df.select("k", "t", "id").distinct().count()


@pytest.mark.parametrize("key", ["customer_id", "merchant_id"])
def test_stored_orders_give_the_same_choice(spark, key):
    draw = random.Random(7)
    at = [None, *(dt.datetime(2020, 1, d) for d in range(1, 6))]
    rows = [(k // 2, draw.choice([None, *range(40)]), draw.choice([None, *range(9)]), draw.choice(at), f"c{k}") for k in range(800)]
    orders = spark.createDataFrame(rows, "order_id int, customer_id int, merchant_id int, order_created_at timestamp, cpf string")
    consumers = spark.createDataFrame([(k, f"n{k}") for k in range(30)], "customer_id int, name string")
    merchants = spark.createDataFrame([(k, f"m{k}") for k in range(5)], "id int, shop string")
    status = spark.createDataFrame([(k, "PLACED", at[1]) for k in range(0, 400, 2)], "order_id int, status_value string, status_created_at timestamp")

    def found(stored):
        df = plans.trusted_order(orders, consumers, merchants, status, DAY, "s", key=key, stored=stored)
        return sorted(map(repr, df.collect()))

    assert found(True) == found(False) != []


def test_raw_orders_are_narrowed_and_documents_not_shuffled_as_text(spark, small, monkeypatch):
    raw, trusted = {}, {}
    write_day, write_gated = driver_queries.sources.write_day, jobs.write_gated

    def day(df, path, *rest):
        raw[path.rsplit("/", 1)[-1]] = plan(df)
        return write_day(df, path, *rest)

    def gated(df, path, *rest):
        trusted[path.rsplit("/", 1)[-1]] = plan(df)
        return write_gated(df, path, *rest)

    monkeypatch.setattr(driver_queries.sources, "write_day", day)
    monkeypatch.setattr(jobs, "write_gated", gated)
    driver_queries.trusted_lake(spark, small)
    above, python, _ = raw["order"].partition("ArrowEvalPython")
    assert python and "Exchange" not in above
    # The scan of whole orders meets the broadcast places before any shuffle.
    lines = trusted["order"].splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "items#" in line)
    shuffle = max(i for i, line in enumerate(lines[:scan]) if "Exchange hashpartitioning" in line)
    assert any("LeftSemi" in line and "getbit" in line for line in lines[shuffle:scan])


def test_orders_meet_their_documents(spark, tmp_path):
    path = tables(spark, tmp_path)
    at = dt.datetime(2020, 1, 1)
    orders = [(1, 5, 10.0, at), (1, 5, 10.0, at), (2, 6, 1.0, None), (3, 5, 2.0, at), (None, 7, 3.0, at)]
    spark.createDataFrame(
        orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp"
    ).write.parquet(f"{path}/orders.parquet")
    found = driver_tables.orders_with_carts(spark, path)
    expected = driver_tables.orders(spark, path).join(driver_tables.carts(spark, path), "order_id", "left")
    assert found.columns == expected.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    assert {r.order_id for r in found.filter("items IS NULL").collect()} == {3, None}
