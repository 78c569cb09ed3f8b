"""Documents written as text over Arrow columns, and the tasks that make them."""

from __future__ import annotations

import datetime as dt
import json

import driver_tables
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from daylake import sources
from driver_documents import _double, documents
from pyspark.sql import functions as F
from test_carts import tables

EMPTY = dict.fromkeys(("name", "number", "kept", *driver_tables.SUMS))
TYPE = pa.struct(
    [("name", pa.string()), ("number", pa.int32()), ("kept", pa.bool_())]
    + [
        (c, pa.float64() if c == "quantity" else pa.string() if c in ("p_name", "flag") or "status" in c else pa.int64())
        for c in driver_tables.SUMS
    ]
)


def made(*orders):
    return documents(pa.array([[EMPTY | {"n": 1} | line for line in lines] for lines in orders], pa.list_(TYPE)))


def test_lines_of_a_name_are_an_item_and_those_of_a_number_a_garnish():
    line = {"name": "x", "quantity": 1.5, "partkey": 7, "p_name": 'a"\n', "greatest_status": "F", "price": 10}
    found = made(
        [line | {"number": 1, "kept": True}, line | {"number": 1, "kept": True, "price": None, "p_name": "Z"},
         line | {"number": 2, "kept": False}, line | {"number": 3, "kept": None}],
        [line | {"number": 1, "kept": True}],
    )
    first, second = map(json.loads, found.to_pylist())
    assert [i["name"] for i in first] == ["x"] and [i["name"] for i in second] == ["x"]
    assert first[0]["quantity"] == 6.0 and first[0]["customerNote"] == "F" and "customerNote" not in second[0]
    assert first[0]["totalValue"] == {"value": "30", "currency": "USD"}
    assert first[0]["totalDiscount"]["value"] == "1" and first[0]["discount"] == {"currency": "USD"}
    garnishes = first[0]["garnishItems"]
    assert [(g["sequence"], g.get("name"), g.get("quantity")) for g in garnishes] == [(1, "Z", 3.0), (3, None, None)]
    assert second[0]["garnishItems"][0]["name"] == 'a"\n'


def test_items_whose_lines_are_all_returned_have_no_garnish():
    assert json.loads(made([{"kept": False}])[0].as_py())[0]["garnishItems"] == []
    assert documents(pa.array([], pa.list_(TYPE))).to_pylist() == []


@pytest.mark.parametrize(
    ("value", "text"),
    [(12.0, "12.0"), (0.1, "0.1"), (1e9, "1.0E9"), (1.5e-5, "1.5E-5"), (-12345678.5, "-1.23456785E7"), (float("nan"), '"NaN"')],
)
def test_doubles_are_written_as_spark_does(spark, value, text):
    assert _double(value) == text
    assert spark.sql(f"SELECT to_json(struct(double('{value}') AS d)) AS j").first()["j"] == f'{{"d":{text}}}'


def test_tasks_grow_with_the_lines(spark, tmp_path, monkeypatch):
    path = tables(spark, tmp_path)
    lines = driver_tables.table(spark, path, "lineitem")
    assert driver_tables._tasks(lines) == 2
    monkeypatch.setattr(driver_tables, "LEAST_LINES", 2)
    assert driver_tables._tasks(lines) == lines.count() // 2
    monkeypatch.setattr(driver_tables, "MOST_LINES", 1)
    assert driver_tables._tasks(lines) == lines.count()


def test_documents_of_a_day_are_shared_out_by_row_groups(spark, tmp_path):
    docs = spark.range(20_000).selectExpr("id AS order_id", "repeat(sha2(string(id), 512), 4) AS items")
    sources.write_by_day(docs.coalesce(1), f"{tmp_path}/order", F.lit(dt.date(2024, 1, 31)), row_group_bytes=1 << 20)
    files = list(tmp_path.rglob("*.parquet"))
    groups = [pq.ParquetFile(f).num_row_groups for f in files]
    assert sum(groups) > 2 * len(files)
    assert sources.scan(spark, f"{tmp_path}/order").count() == 20_000
