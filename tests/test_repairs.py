"""Days that are replaced, total orders, gated runs side by side, columns that come later, raw history."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import driver_tables
from daylake import operators as ops
from daylake import plans, sources
from daylake.sources import commits

D1, D2 = dt.date(2021, 5, 1), dt.date(2021, 5, 2)


def test_a_day_rewritten_without_rows_is_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_day(spark.range(5), path, D1)
    sources.write_day(spark.range(3), path, D2)
    sources.write_day(spark.range(0), path, D1)
    rows = sources.scan(spark, path, day_column="partition_column").collect()
    assert {r[1] for r in rows} == {D2} and len(rows) == 3


@pytest.mark.parametrize("partitions", [1, 3, 7])
@pytest.mark.parametrize("turned", [False, True])
def test_latest_has_one_winner_whatever_the_order_of_rows(spark, partitions, turned):
    rows = [(1, 10, 5, f"doc{i}", {"a": i}) for i in range(8)]
    df = spark.createDataFrame(rows[::-1] if turned else rows, "k int, t int, id int, items string, m map<string,int>")
    got = ops.latest(df.repartition(partitions), "k", "t", ["id"]).collect()
    assert [r["items"] for r in got] == ["doc7"]


def test_gated_runs_of_two_days_do_not_meet(spark, tmp_path, monkeypatch):
    from daylake.sources import writers

    path = str(tmp_path / "t")
    real, inner = writers.latest_day_before, []

    def other_run_in_between(*args):
        if not inner:
            inner.append(1)
            inner.append(sources.write_gated(spark.range(90), path, D2))
        return real(*args)

    monkeypatch.setattr(writers, "latest_day_before", other_run_in_between)
    first = sources.write_gated(spark.range(95), path, D1)
    assert first.actual == 95 and inner[1].actual == 90
    days = dict(map(tuple, sources.scan(spark, path).groupBy("partition").count().collect()))
    assert days == {D1: 95, D2: 90}
    # Each run has a folder of its own, and none is left that is no day's.
    runs = {f"{p.parent.name}/{p.name}" for p in (tmp_path / "t").glob("partition=*/_*")}
    assert runs == set(commits.newest(spark, path).days.values()) and len(runs) == 2


def test_rows_without_a_day_do_not_stop_the_gate(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, D1), (2, None)], "id int, day date")
    sources.write_by_day(df, path, F.col("day"))
    assert sources.write_gated(spark.range(4).select(F.col("id").cast("int"), F.lit(D1).alias("day")), path, D2).previous == 1


def test_a_column_of_a_later_day_is_null_before(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_day(spark.range(2), path, D1, "partition")
    sources.write_day(spark.range(2).withColumn("late", F.lit(7)), path, D2, "partition")
    for schema in (None, spark.range(0).withColumn("late", F.lit(7)).schema):
        got = sources.scan(spark, path, schema=schema).groupBy("partition").agg(F.sum("late")).collect()
        assert dict(map(tuple, got)) == {D1: None, D2: 14}
    assert "late" in sources.scan(spark, path, D2).columns


def test_json_is_not_inferred_unasked(spark, tmp_path):
    with pytest.raises(ValueError):
        sources.read_source(spark, str(tmp_path), "json")


def test_orders_keep_the_statuses_of_earlier_raw_days(spark, tmp_path):
    zones = {z: str(tmp_path / z) for z in ("source", "raw", "trusted")}
    status = lambda o, v: spark.createDataFrame([(o, v, 1)], "order_id string, value string, created_at int")
    sources.write_day(status("a", "PLACED"), f"{zones['raw']}/status", D1)
    sources.write_day(status("b", "PLACED"), f"{zones['raw']}/status", D2)
    orders = f"{zones['trusted']}/order"
    sources.write_day(spark.createDataFrame([("a",)], "order_id string"), orders, D1, "partition")
    sources.write_day(spark.createDataFrame([("b",)], "order_id string"), orders, D2, "partition")
    plans.refresh_order_statuses(spark, zones, D2)
    got = sources.scan(spark, f"{zones['trusted']}/order_statuses").collect()
    assert {(r.order_id, r.status_2) for r in got} == {("a", "PLACED"), ("b", "PLACED")}
    only = plans.refresh_order_statuses(spark, zones, D2, raw_day=D2)
    assert only.actual == 2


def test_every_line_of_a_large_order_is_counted(spark, small, tmp_path):
    for name in ("lineitem", "part"):
        df = driver_tables.table(spark, small, name)
        if name == "lineitem":
            df = df.limit(2_000).withColumn("l_orderkey", F.lit(1).cast(df.schema["l_orderkey"].dataType))
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    got = ops.order_items(driver_tables.carts(spark, str(tmp_path)))
    items = got.select("name", F.col("addition").cast("long").alias("n")).distinct()
    assert driver_tables.carts(spark, str(tmp_path)).count() == 1
    assert items.agg(F.sum("n")).first()[0] == 2_000
