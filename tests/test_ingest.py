"""Ingest of several datasets at once, and records that do not fit."""

from __future__ import annotations

import datetime as dt
import gzip
import threading

import pytest
from pyspark.sql import types as T

from daylake import plans, sources

D1 = dt.date(2020, 7, 18)


def write_gz(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode()))


@pytest.fixture()
def zones(tmp_path):
    return {name: str(tmp_path / name) for name in ("source", "raw", "quarantine")}


def ddl(text):
    return T.StructType.fromDDL(text)


def deliver(zones, name, fmt, text):
    from pathlib import Path

    write_gz(Path(zones["source"]) / f"{name}.{fmt}.gz", text)


def test_one_broken_dataset_stops_no_other(spark, zones):
    deliver(zones, "a", "csv", "id\n1\n2\n")
    deliver(zones, "c", "json", '{"id": 1}\n{"id": 2}\n{"id": 3}\n')
    manifest = [("a", "csv"), ("missing", "csv"), ("c", "json"), ("d", "orc")]
    got = plans.ingest_each(spark, zones, manifest, D1)
    assert [(r.dataset, r.error is None) for r in got] == [("a", True), ("missing", False), ("c", True), ("d", False)]
    assert "PATH_NOT_FOUND" in got[1].error and "orc" in got[3].error
    assert sources.scan(spark, got[0].path, D1, "partition_column").count() == 2
    assert sources.scan(spark, got[2].path, D1, "partition_column").count() == 3
    with pytest.raises(plans.IngestFailed, match="missing: .*; d: ") as failed:
        plans.ingest(spark, zones, manifest, D1)
    assert [r.error is None for r in failed.value.results] == [True, False, True, False]


def test_a_type_that_changed_is_reported(spark, zones):
    deliver(zones, "a", "json", '{"id": 1}\n')
    plans.ingest(spark, zones, [("a", "json", ddl("id bigint"))], D1)
    got = plans.ingest_each(spark, zones, [("a", "json", ddl("id string"))], D1)
    assert got[0].error.startswith("SchemaConflict")
    assert sources.scan(spark, got[0].path, D1, "partition_column").schema["id"].dataType == T.LongType()


def test_datasets_run_side_by_side_in_their_pools(spark, zones, monkeypatch):
    names = ["a", "b", "c", "d"]
    for name in names:
        deliver(zones, name, "csv", "id\n1\n")
    together, pools, real = threading.Barrier(4, timeout=60), {}, plans.jobs.write_day

    def meet(df, path, *rest):
        # Four writers only meet here if none waits for another to end.
        together.wait()
        pools[path.rsplit("/", 1)[-1]] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        return real(df, path, *rest)

    monkeypatch.setattr(plans.jobs, "write_day", meet)
    got = plans.ingest_each(spark, zones, [(n, "csv") for n in names], D1, side_by_side=4)
    assert all(r.error is None for r in got) and pools == {n: n for n in names}
    assert plans.ingest_each(spark, zones, [], D1) == []


CSV = 'id,n,day\n1,10,2020-01-01\n2,x,2020-01-02\n3,30\n4,40,2020-01-04,more\n"5",,\n6,60,no day\n'
JSON = '{"id": 1, "tags": ["a"]}\n{"id": "two"}\n{"id": 3, "tags": "b"}\nnot json\n{"id": 4}\n{"id": 5, "unknown": 1}\n'


@pytest.mark.parametrize(
    "fmt, text, schema, fit",
    [("csv", CSV, "id int, n int, day date", {1, 5}), ("json", JSON, "id bigint, tags array<string>", {1, 4, 5})],
)
def test_rows_that_fit_and_rows_set_aside_make_up_the_source(spark, zones, fmt, text, schema, fit):
    deliver(zones, "t", fmt, text)
    entry = [("t", fmt, ddl(schema))]
    plans.ingest(spark, zones, entry, D1, quarantine=True)
    records = text.splitlines()[1 if fmt == "csv" else 0 :]
    good = sources.scan(spark, f"{zones['raw']}/t", D1, "partition_column")
    bad = sources.scan(spark, f"{zones['quarantine']}/t", D1, "partition_column")
    assert {r.id for r in good.collect()} == fit and good.columns == [*ddl(schema).names, "partition_column"]
    set_aside = [r._record for r in bad.collect()]
    assert len(set_aside) + len(fit) == len(records) and set(set_aside) <= set(records)
    # Running the day again replaces both tables' day.
    again = plans.ingest_each(spark, zones, entry, D1, quarantine=True)
    assert [r.set_aside for r in again] == [len(set_aside)]
    assert sources.scan(spark, f"{zones['raw']}/t").count() + sources.scan(spark, f"{zones['quarantine']}/t").count() == len(records)


@pytest.mark.parametrize("text, good, bad", [("id\n1\n2\n", 2, 0), ("id\nx\n", 0, 1), ("id\n", 0, 0)])
def test_all_or_none_may_fit(spark, zones, text, good, bad):
    deliver(zones, "t", "csv", text)
    plans.ingest(spark, zones, [("t", "csv", ddl("id int"))], D1, quarantine=True)
    assert sources.scan(spark, f"{zones['raw']}/t", D1).count() == good
    assert sources.scan(spark, f"{zones['quarantine']}/t", D1).count() == bad


def test_the_source_is_read_once(spark, zones):
    deliver(zones, "t", "csv", CSV)
    sc, jobs = spark.sparkContext, []
    tracker = sc.statusTracker()
    sc.setJobGroup("quarantine", "split")
    try:
        plans.jobs._ingest_split(spark, zones, "t", "csv", ddl("id int, n int, day date"), D1)
        jobs = tracker.getJobIdsForGroup("quarantine")
    finally:
        sc.setJobGroup("", "")
    assert len(jobs) == 1


def test_without_a_schema_nothing_is_set_aside(spark, zones):
    deliver(zones, "t", "csv", "id\nx\n")
    plans.ingest(spark, zones, [("t", "csv")], D1, quarantine=True)
    assert sources.scan(spark, f"{zones['raw']}/t", D1, "partition_column").count() == 1
    with pytest.raises(ValueError):
        sources.read_source(spark, f"{zones['source']}/t.csv.gz", "csv", corrupt="_record")
