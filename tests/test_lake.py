"""Sources, sinks and the two jobs on real files."""

from __future__ import annotations

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from daylake import plans, sources
from daylake.sources.readers import count_day
from daylake.sources.zones import work_dir

D1, D2, D3 = (dt.date(2020, 7, d) for d in (18, 19, 20))


def test_zone_paths():
    zones = {"source": "s3a://in/", "raw": "/lake/raw"}
    assert sources.zone_path(zones, "source", "order", "json") == "s3a://in/order.json.gz"
    assert sources.zone_path(zones, "raw", "order") == "/lake/raw/order"
    with pytest.raises(ValueError):
        sources.zone_path(zones, "source", "order")


def test_work_dir_is_the_shared_folder(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_rewriting_a_day_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_day(spark.range(3), path, D1)
    sources.write_day(spark.range(5), path, D2)
    sources.write_day(spark.range(2), path, D1)
    got = sources.scan(spark, path).groupBy("partition_column").count()
    assert dict(map(tuple, got.collect())) == {D1: 2, D2: 5}
    assert sources.scan(spark, path, D2, "partition_column").count() == 5


def test_rows_go_to_their_own_day(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, D1), (2, D1), (3, D2)], "id int, day date")
    sources.write_by_day(df, path, df.day)
    sources.write_by_day(df.filter("id = 3"), path, df.day)
    assert {r.id for r in sources.scan(spark, path, D1).collect()} == {1, 2}
    assert sources.latest_day_before(spark, path, D2) == D1
    assert sources.latest_day_before(spark, path, D1) is None


def test_flat_table_and_file_count(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_flat(spark.range(10), path, files=3)
    sources.write_flat(spark.range(100), path, files=3)
    assert spark.read.parquet(path).count() == 100
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 3
    sources.write_flat(spark.range(100).repartition(7), path, files=sources.AUTO)
    assert spark.read.parquet(path).count() == 100
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 1


def test_gate_without_a_previous_day(spark, tmp_path):
    path = str(tmp_path / "order")
    empty = sources.write_gated(spark.range(0), path, D1)
    assert (empty.actual, empty.previous, empty.written) == (0, 1, False)
    assert not (tmp_path / "order").exists()
    assert sources.write_gated(spark.range(1), path, D1) == ("order", D1, 1, 1, True)


def test_refused_day_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "order")
    assert sources.write_gated(spark.range(100), path, D1).written
    assert sources.write_gated(spark.range(90), path, D3).written
    refused = sources.write_gated(spark.range(20), path, D2)
    assert (refused.actual, refused.previous, refused.written) == (20, 100, False)
    assert sources.write_gated(spark.range(18), path, D3).written is False
    assert count_day(spark, path, D1) == 100
    assert count_day(spark, path, D2) is None
    assert count_day(spark, path, D3) == 90
    loose = sources.write_gated(spark.range(20), path, D2, max_drop_percent=81)
    assert loose.written and count_day(spark, path, D2) == 20


def test_gated_rows_run_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    df = spark.range(50).repartition(2).mapInArrow(touch, "id long")
    sources.write_gated(df, str(tmp_path / "t"), D1)
    assert runs.value == 50


def test_inventory(spark, tmp_path):
    base = str(tmp_path)
    sources.write_flat(spark.range(10), f"{base}/trusted/order", files=2)
    sources.write_flat(spark.range(10), f"{base}/raw/status", files=1)
    files = sources.file_inventory(spark, base, pattern="*.parquet", prefix="trusted/", suffix=".parquet")
    got = files.collect()
    assert len(got) == 2
    assert {r.dataset for r in got} == {"trusted"} and all(r.length > 0 for r in got)
    assert all(r.key.startswith("trusted/order/part-") for r in got)
    assert sources.file_inventory(spark, base, pattern="*.parquet").count() == 3


def write_gz(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode()))


def at(day, hour):
    return f"2020-07-{day:02d}T{hour:02d}:00:00.000Z"


@pytest.fixture()
def lake(tmp_path):
    source = tmp_path / "in"
    cart = json.dumps(
        [
            {"name": "i1", "garnishItems": [{"externalId": "G1", "quantity": 1}, {"externalId": "G2", "quantity": 2}]},
            {"name": "i2", "garnishItems": [{"externalId": "G1", "quantity": 3}]},
        ]
    )
    orders = [
        {"order_id": f"o{i}", "customer_id": f"c{i % 2}", "merchant_id": "m", "order_created_at": at(1, i),
         "cpf": " 123 ", "customer_name": "n", "items": cart}
        for i in range(4)
    ]
    status = [
        {"order_id": f"o{i}", "created_at": at(2, h), "value": v}
        for i in range(4)
        for h, v in ((1, "REGISTERED"), (2, "PLACED"), (3, "CONCLUDED"))
    ]
    write_gz(source / "order.json.gz", "\n".join(map(json.dumps, orders)))
    write_gz(source / "status.json.gz", "\n".join(map(json.dumps, status)))
    write_gz(source / "consumer.csv.gz", "customer_id,created_at,customer_name,customer_phone_number\n"
             f"c0,{at(1, 1)},n,12\nc1,{at(1, 1)},n,x\n")
    write_gz(source / "restaurant.csv.gz", f"id,created_at,name\nm,{at(1, 1)},r\n")
    return {"source": str(source), "raw": str(tmp_path / "raw"), "trusted": str(tmp_path / "trusted")}


MANIFEST = [("order", "json"), ("consumer", "csv"), ("status", "json"), ("restaurant", "csv")]


def test_csv_stays_text_unless_asked(spark, lake):
    path = sources.zone_path(lake, "source", "consumer", "csv")
    assert {t for _, t in sources.read_source(spark, path, "csv").dtypes} == {"string"}
    assert dict(sources.read_source(spark, path, "csv", infer=True).dtypes)["created_at"] == "timestamp"
    with pytest.raises(ValueError):
        sources.read_source(spark, path, "orc")


def test_jobs_end_to_end(spark, lake):
    plans.ingest(spark, lake, MANIFEST, D2)
    first = plans.refresh_trusted(spark, lake, D2, "salt")
    assert [(r.dataset, r.actual, r.written) for r in first] == [
        ("order", 2, True), ("order_items", 10, True), ("order_statuses", 2, True),
    ]
    orders = sources.scan(spark, f"{lake['trusted']}/order")
    got = {r.customer_id: r for r in orders.collect()}
    assert (got["c0"].order_id, got["c1"].order_id) == ("o2", "o3")
    assert (got["c0"].customer_phone_number, got["c1"].customer_phone_number) == (30.0, None)
    assert len(got["c0"].cpf) == 64 and "customer_name" not in orders.columns
    assert (got["c0"].status_value, got["c0"].partition) == ("CONCLUDED", D2)

    statuses = sources.scan(spark, f"{lake['trusted']}/order_statuses").first()
    assert (statuses.status_1, statuses.status_3, statuses.status_4) == ("REGISTERED", "CONCLUDED", None)

    # The next day repeats every order: copies merge, and the earlier day stays.
    plans.ingest(spark, lake, MANIFEST, D3)
    second = plans.refresh_trusted(spark, lake, D3, "salt")
    assert [(r.actual, r.previous, r.written) for r in second] == [(2, 2, True), (10, 10, True), (2, 2, True)]
    days = sources.scan(spark, f"{lake['trusted']}/order_items").groupBy("partition").count()
    assert dict(map(tuple, days.collect())) == {D2: 10, D3: 10}
    assert plans.refresh_order_items(spark, lake, D3, day=D3, per_item=True).actual == 6
    assert plans.refresh_order_statuses(spark, lake, D3, latest_only=True).actual == 2


def test_trusted_orders_by_the_day_of_the_merchant(spark, lake):
    plans.ingest(spark, lake, MANIFEST, D2)
    raw = {n: f"{lake['raw']}/{n}" for n, _ in MANIFEST}
    df = plans.trusted_order(
        sources.raw_orders(spark, raw["order"], D2),
        sources.raw_consumers(spark, raw["consumer"], D2),
        sources.raw_merchants(spark, raw["restaurant"], D2),
        sources.raw_status(spark, raw["status"], D2),
        D2,
        "salt",
    )
    path = f"{lake['trusted']}/by_merchant_day"
    sources.write_by_day(df, path, F.to_date("restaurant_created_at"), "restaurant_partition")
    got = spark.read.parquet(path).groupBy("restaurant_partition").count().collect()
    assert [tuple(r) for r in got] == [(dt.date(2020, 7, 1), 2)]
