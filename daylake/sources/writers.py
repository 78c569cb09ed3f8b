"""Parquet sinks: one day of a table, a flat table, and the gated snapshot."""

from __future__ import annotations

import datetime as dt
import logging
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from daylake.operators.quality import MAX_DROP_PERCENT, passes_gate
from daylake.sources import commits
from daylake.sources.commits import DAY
from daylake.sources.files import remove
from daylake.sources.readers import RAW_DAY, count_day, latest_day_before

log = logging.getLogger(__name__)


class GateResult(NamedTuple):
    dataset: str
    run_date: dt.date
    actual: int
    previous: int
    written: bool


def stamp(df: DataFrame, run_date: dt.date, column: str = DAY) -> DataFrame:
    """Add the run day as a date column."""
    return df.withColumn(column, F.lit(run_date))


AUTO = "auto"


def _sized(df: DataFrame, files: int | str | None) -> DataFrame:
    # A fixed file count is for small tables: it also fixes the number of writing tasks. With
    # AUTO the rows are rebalanced into files of the session's advisory partition size.
    if files == AUTO:
        return df.hint("rebalance")
    return df if files is None else df.repartition(files)


def write_day(
    df: DataFrame, path: str, run_date: dt.date, column: str = RAW_DAY, files: int | str | None = None
) -> None:
    """Write `df` as one day of the table at `path`, replacing that day only.

    Without rows no file of the day would be touched, so its folder is then removed. A day of a table with
    commits is written unseen and then promoted.
    """
    if commits.newest(df.sparkSession, path) is not None:
        commits.promote(df.sparkSession, commits.stage(_sized(df, files), path, run_date, column))
        return
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    (
        _sized(stamp(counted, run_date, column), files)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    if not written.get["rows"]:
        remove(df.sparkSession, f"{path}/{column}={run_date.isoformat()}")


def write_by_day(
    df: DataFrame, path: str, day: Column, column: str = DAY, row_group_bytes: int | None = None
) -> None:
    """Write every row to the day it belongs to, replacing only the days present in `df`.

    Rows are gathered by day first, so that each day gets few files; a day with very many rows
    is spread over several tasks again. A table with commits takes one day at a time. Readers share out a file by its
    row groups; `row_group_bytes` keeps them small where rows take far more work than their bytes on disk suggest.
    """
    if commits.newest(df.sparkSession, path) is not None:
        raise ValueError(f"{path} has commits; write its days one by one")
    groups = {} if row_group_bytes is None else {"parquet.block.size": row_group_bytes}
    (
        df.withColumn(column, day)
        .hint("rebalance", column)
        .write.mode("overwrite")
        .options(compression="zstd", partitionOverwriteMode="dynamic", **groups)
        .partitionBy(column)
        .parquet(path)
    )


def write_flat(df: DataFrame, path: str, files: int | str | None = None) -> None:
    """Replace an unpartitioned table."""
    _sized(df, files).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_gated(
    df: DataFrame,
    path: str,
    run_date: dt.date,
    files: int | str | None = None,
    max_drop_percent: int = MAX_DROP_PERCENT,
) -> GateResult:
    """Write a day of the table at `path` unless its row count fell too far.

    The rows are compared with the newest day before `run_date`; without one the previous count is 1, so only
    an empty first day is refused. `df` runs once and its rows are written once, into a folder that no reader
    sees. Their count comes from the file footers, so retried tasks cannot distort it. A commit then makes them
    the day, at once: a run that ends before it, or is refused, leaves the table as it was. The replaced
    rows stay for readers that hold them until `commits.vacuum`.
    """
    dataset = path.rstrip("/").rsplit("/", 1)[-1]
    spark = df.sparkSession
    staged = commits.stage(_sized(df, files), path, run_date)
    try:
        actual = commits.rows_of(spark, staged).count()
        before = latest_day_before(spark, path, run_date)
        previous = None if before is None else count_day(spark, path, before)
        previous = 1 if previous is None else previous
        written = passes_gate(actual, previous, max_drop_percent)
        if written:
            commits.promote(spark, staged)
    except BaseException:
        commits.discard(spark, staged)
        raise
    if not written:
        commits.discard(spark, staged)
        log.warning("%s refused: %d rows after %d", dataset, actual, previous)
    return GateResult(dataset, run_date, actual, previous, written)
