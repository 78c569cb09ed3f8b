"""Days that change at once, and rows that are written once."""

from __future__ import annotations

import datetime as dt
import os
import signal
import subprocess
import sys
import time
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from daylake import sources
from daylake.sources import commits, files
from daylake.sources.readers import Days, count_day, latest_day_before

D1, D2, D3, D4 = (dt.date(2020, 7, d) for d in (18, 19, 20, 21))


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_run_that_ends_before_the_commit_leaves_the_old_day(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sources.write_gated(spark.range(5), path, D1).written
    staged = commits.stage(spark.range(100), path, D1)
    assert ids(sources.scan(spark, path)) == list(range(5)) and count_day(spark, path, D1) == 5
    assert latest_day_before(spark, path, D2) == D1
    commits.promote(spark, staged)
    assert count_day(spark, path, D1) == 100


def test_a_reader_keeps_the_day_it_has_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_gated(spark.range(5), path, D1)
    before = sources.scan(spark, path)
    sources.write_gated(spark.range(7), path, D1)
    assert before.count() == 5 and sources.scan(spark, path).count() == 7


KILLED = """
import datetime as dt, sys
from pyspark.sql import SparkSession
from daylake import sources
from daylake.sources import commits
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.warehouse.dir", sys.argv[1] + "-warehouse").getOrCreate())
sources.write_gated(spark.range(5), sys.argv[1], dt.date(2020, 7, 18))
real = commits.promote
def slow(*a):
    print("staged", flush=True)
    import time; time.sleep(600)
commits.promote = slow
sources.write_gated(spark.range(50), sys.argv[1], dt.date(2020, 7, 18))
"""


def test_a_killed_process_leaves_the_old_day_readable(spark, tmp_path):
    path = str(tmp_path / "t")
    root = str(Path(__file__).resolve().parents[1])
    run = subprocess.Popen(
        [sys.executable, "-c", KILLED, path], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, text=True,
        env={**os.environ, "PYTHONPATH": root}, start_new_session=True,
    )
    try:
        assert run.stdout.readline().strip() == "staged"
    finally:
        os.killpg(run.pid, signal.SIGKILL)
        run.wait()
    assert len(list((tmp_path / "t" / f"partition={D1}").iterdir())) == 2
    assert ids(sources.scan(spark, path)) == list(range(5))
    assert sources.write_gated(spark.range(6), path, D2).previous == 5
    # What the killed run left goes once it is old enough; the days stay.
    assert sources.vacuum(spark, path) == []
    assert len(sources.vacuum(spark, path, older_than=0)) == 1
    assert sources.scan(spark, path).count() == 11


def test_rows_are_written_once(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_gated(spark.range(1_000).repartition(3), path, D1)
    found = [p for p in tmp_path.rglob("part-*.parquet") if p.is_file()]
    assert len(found) == 3
    commit = commits.newest(spark, path)
    assert all(commit.days[D1] in str(p) for p in found)


def test_refused_and_failed_runs_leave_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_gated(spark.range(100), path, D1)
    before = sorted(str(p) for p in tmp_path.rglob("*"))
    assert not sources.write_gated(spark.range(3), path, D2).written
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sources.write_gated(spark.range(9).select((F.col("id") / (F.col("id") - 4).cast("int")).alias("id")), path, D2)
    assert sorted(str(p) for p in tmp_path.rglob("*")) == before


def test_days_of_one_commit_change_together(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [commits.stage(spark.range(n), path, d) for n, d in ((2, D1), (3, D2))]
    assert commits.promote(spark, *first) == 1
    assert {r.partition: r["count"] for r in sources.scan(spark, path).groupBy("partition").count().collect()} == {D1: 2, D2: 3}


def test_forgotten_days_go_with_their_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in (D1, D2, D3):
        commits.promote(spark, commits.stage(spark.range(2), path, day))
    commits.promote(spark, commits.stage(spark.range(5), path, D4), forget_before=D3)
    assert sorted(commits.newest(spark, path).days) == [D3, D4] and sources.scan(spark, path).count() == 7
    assert len(sources.vacuum(spark, path, keep=1, older_than=0)) == 2
    assert sources.scan(spark, path).count() == 7 and latest_day_before(spark, path, D3) is None


def test_writers_at_once_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [D1 + dt.timedelta(days=k) for k in range(8)]
    staged = [commits.stage(spark.range(k + 1), path, d) for k, d in enumerate(days)]
    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(lambda s: commits.promote(spark, s), staged))
    assert sorted(versions) == list(range(1, 9))
    assert sources.scan(spark, path).count() == sum(range(1, 9))


def test_plain_days_remain_when_commits_begin(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_day(spark.range(4), path, D1, "partition")
    sources.write_day(spark.range(10).withColumn("late", F.lit("x")), path, D2, "partition")
    gate = sources.write_gated(spark.range(9).withColumn("more", F.lit(1.5)), path, D3)
    assert (gate.previous, gate.written) == (10, True)
    table = sources.scan(spark, path)
    assert table.columns == ["id", "late", "more", "partition"] and table.count() == 23
    assert sources.scan(spark, path, D1).filter("late IS NULL AND more IS NULL").count() == 4
    # From now on plain writes of a day are commits as well, and days have one column only.
    sources.write_day(spark.range(1), path, D1, "partition")
    assert count_day(spark, path, D1) == 1
    with pytest.raises(ValueError):
        sources.write_by_day(spark.range(1), path, F.lit(D4))
    with pytest.raises(ValueError):
        sources.write_day(spark.range(1), path, D1, "partition_column")


def test_ranges_of_days(spark, tmp_path):
    plain, path = str(tmp_path / "p"), str(tmp_path / "t")
    for k, day in enumerate((D1, D2, D3, D4)):
        sources.write_day(spark.range(k, k + 1), plain, day)
        sources.write_gated(spark.range(k, k + 1), path, day)
    for table, column in ((plain, "partition_column"), (path, "partition")):
        assert ids(sources.scan(spark, table, Days(D1, D3), column)) == [1, 2]
        assert ids(sources.scan(spark, table, Days(None, D2), column)) == [0, 1]
        assert ids(sources.scan(spark, table, Days(D4, D4), column)) == []


def test_publish_takes_a_name_once(spark, tmp_path):
    path = f"{tmp_path}/notes/1.json"
    assert files.publish(spark, path, "first") and not files.publish(spark, path, "second")
    assert files.read_text(spark, path) == "first" and files.names(spark, f"{tmp_path}/notes") == ["1.json"]


def test_scan_of_a_commit_reads_no_footer(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_gated(spark.range(5), path, D1)
    sources.write_gated(spark.range(6), path, D2)
    folder = tmp_path / "t" / commits.newest(spark, path).days[D1]
    for file in folder.glob("*.parquet"):
        file.write_bytes(b"no parquet at all")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    start = time.time()
    assert sources.scan(spark, path, D2).count() == 6 and time.time() - start < 30
    assert sources.scan(spark, path).columns == ["id", "partition"]
