"""Declared schemas: versions, defaults, and scans that read no footers."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import types as T

from daylake import plans, sources
from daylake.sources import Registry, SchemaConflict
from daylake.sources.registry import merged
from test_lake import D2, D3, MANIFEST, lake  # noqa: F401: the fixture

D1 = dt.date(2020, 7, 18)


def schema(text):
    return T.StructType.fromDDL(text)


def test_versions_add_and_widen(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    assert registry.schema("t") is None and registry.versions("t") == []
    assert registry.declare("t", schema("a int, b struct<x: int>")) == 1
    assert registry.declare("t", schema("a int")) == 1
    assert registry.declare("t", schema("A bigint, c string, b struct<y: string>")) == 2
    assert registry.schema("t").simpleString() == "struct<a:bigint,b:struct<x:int,y:string>,c:string>"
    assert registry.schema("t", 1).simpleString() == "struct<a:int,b:struct<x:int>>"
    with pytest.raises(SchemaConflict, match="b.x"):
        registry.declare("t", schema("b struct<x: string>"))
    assert registry.versions("t") == [1, 2]


@pytest.mark.parametrize(
    "old, new, both",
    [
        ("int", "bigint", "bigint"), ("float", "double", "double"), ("tinyint", "smallint", "smallint"), ("int", "double", "double"),
        ("date", "timestamp_ntz", "timestamp_ntz"), ("array<int>", "array<bigint>", "array<bigint>"),
        ("map<string, int>", "map<string, bigint>", "map<string,bigint>"), ("void", "string", "string"),
    ],
)
def test_widening_is_the_same_both_ways(old, new, both):
    for a, b in ((old, new), (new, old)):
        assert merged(schema(f"c {a}"), schema(f"c {b}"))["c"].dataType.simpleString() == both


@pytest.mark.parametrize("old, new", [("string", "int"), ("bigint", "double"), ("decimal(9,2)", "double"), ("array<int>", "int")])
def test_types_without_a_common_one_conflict(old, new):
    with pytest.raises(SchemaConflict):
        merged(schema(f"c {old}"), schema(f"c {new}"))


def test_writers_at_once_keep_all_columns(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda k: registry.declare("t", schema(f"c{k} int")), range(6)))
    assert set(registry.schema("t").names) == {f"c{k}" for k in range(6)}


def test_old_files_read_with_nulls_and_defaults(spark, tmp_path):
    registry, path = Registry(spark, str(tmp_path / "s")), str(tmp_path / "t")
    sources.write_day(spark.sql("SELECT 1 AS id, CAST(7 AS INT) AS n"), path, D1)
    sources.write_day(spark.sql("SELECT 2 AS id, CAST(8 AS BIGINT) AS n, CAST(NULL AS STRING) AS tag, 'x' AS note"), path, D2)
    registry.declare("t", schema("id int, n int"))
    registry.declare("t", schema("id int, n bigint, tag string, note string"), {"tag": "'none'"})
    got = sources.scan(spark, path, day_column="partition_column", schema=registry.schema("t"))
    # A default stands for a column that a file lacks, not for a null that it holds.
    assert sorted(tuple(r) for r in got.collect()) == [(1, 7, "none", None, D1), (2, 8, None, "x", D2)]
    with pytest.raises(ValueError):
        registry.declare("t", schema("id int"), {"other": "1"})


@pytest.fixture()
def merges(monkeypatch):
    """How often a reader is told to merge the schemas of all files."""
    from pyspark.sql import DataFrameReader

    seen, option = [], DataFrameReader.option

    def spy(self, key, value):
        if key.lower() == "mergeschema":
            seen.append(value)
        return option(self, key, value)

    monkeypatch.setattr(DataFrameReader, "option", spy)
    return seen


def test_jobs_merge_no_footers(spark, lake, merges, tmp_path):  # noqa: F811
    plans.ingest(spark, lake, MANIFEST, D2)
    assert [r.written for r in plans.refresh_trusted(spark, lake, D2, "salt")] == [True] * 3
    # A file of another day that is no Parquet would fail any read of its footer.
    broken = tmp_path / "raw" / "order" / f"partition_column={D1}"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"no parquet at all")
    plans.ingest(spark, lake, MANIFEST, D3)
    assert [r.written for r in plans.refresh_trusted(spark, lake, D3, "salt")] == [True] * 3
    assert plans.refresh_order_items(spark, lake, D3, day=D3).written
    assert plans.refresh_order_statuses(spark, lake, D3, day=D3, raw_day=D3).written
    assert merges == []
    for name, read in (("order", sources.raw_orders), ("status", sources.raw_status), ("consumer", sources.raw_consumers), ("restaurant", sources.raw_merchants)):
        declared = plans.registry(spark, lake).schema(name)
        assert read(spark, f"{lake['raw']}/{name}", D3, declared).count() > 0
    assert merges == []


def test_tables_from_before_the_registry_are_declared_once(spark, lake, merges):  # noqa: F811
    plans.ingest(spark, lake, MANIFEST, D2)
    declared = {n: plans.registry(spark, lake).schema(n) for n, _ in MANIFEST}
    from daylake.sources.files import remove

    remove(spark, f"{lake['raw']}/_schemas")
    assert plans.refresh_orders(spark, lake, D2, "salt").written and len(merges) == 4
    assert plans.refresh_orders(spark, lake, D2, "salt").written and len(merges) == 4
    assert {n: plans.registry(spark, lake).schema(n) for n, _ in MANIFEST} == declared


def test_json_is_inferred_once(spark, lake, monkeypatch):  # noqa: F811
    from daylake.sources import readers

    seen, read = [], readers.read_source

    def spy(spark, path, fmt, schema=None, infer=False, corrupt=None):
        seen.append((fmt, infer))
        return read(spark, path, fmt, schema, infer, corrupt)

    monkeypatch.setattr(readers, "read_source", spy)
    plans.ingest(spark, lake, MANIFEST, D2)
    plans.ingest(spark, lake, MANIFEST, D3)
    assert seen == [(f, f == "json") for _, f in MANIFEST] + [(f, False) for _, f in MANIFEST]
