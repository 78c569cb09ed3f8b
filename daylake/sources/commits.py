"""Tables whose days change at once: rows are written once, and one small file makes them the table's.

A day's rows lie in a folder that plain listings pass over, `partition=<day>/_<run>`. `_commits` holds one numbered
file for each change, with the folder of every day and the schema of the table. Readers take the newest
one; a run that ends before it has written its own changes nothing they see.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daylake.sources import files
from daylake.sources.registry import merged

DAY = "partition"
LOG = "_commits"


class Commit(NamedTuple):
    version: int
    schema: T.StructType
    #: Folder of each day, below the table.
    days: dict[dt.date, str]
    day_column: str = DAY


class Staged(NamedTuple):
    """A day's rows that no reader sees yet."""

    table: str
    day: dt.date
    folder: str
    schema: T.StructType
    day_column: str = DAY


def _date(name: str) -> dt.date | None:
    # Rows without a day are in a folder whose name is no date.
    try:
        return dt.date.fromisoformat(name)
    except ValueError:
        return None


def plain_days(spark: SparkSession, table: str, day_column: str = DAY) -> dict[dt.date, str]:
    """Days by the folders of a table, and their folders. Only folder names are listed, one per day."""
    found = [n for n in files.names(spark, table) if n.startswith(f"{day_column}=")]
    return {day: n for n in found if (day := _date(n.split("=", 1)[1]))}


def newest(spark: SparkSession, table: str) -> Commit | None:
    """The last commit of a table; None if it has none."""
    numbers = [n for n in files.names(spark, f"{table}/{LOG}") if n.endswith(".json") and not n.startswith(".")]
    return _commit(spark, table, numbers[-1]) if numbers else None


def _commit(spark: SparkSession, table: str, name: str) -> Commit:
    note = json.loads(files.read_text(spark, f"{table}/{LOG}/{name}"))
    days = {dt.date.fromisoformat(day): folder for day, folder in note["days"].items()}
    return Commit(int(name.split(".")[0]), T.StructType.fromJson(note["schema"]), days, note["day_column"])


def _run_folder(day: dt.date, day_column: str) -> str:
    return f"{day_column}={day.isoformat()}/_{uuid.uuid4().hex}"


def stage(df: DataFrame, table: str, day: dt.date, day_column: str = DAY) -> Staged:
    """Write a day's rows where they will stay, unseen until `promote`."""
    folder = _run_folder(day, day_column)
    rows = df.drop(day_column)
    try:
        rows.write.option("compression", "zstd").parquet(f"{table}/{folder}")
    except BaseException:
        _clear(df.sparkSession, table, folder)
        raise
    return Staged(table, day, folder, rows.schema, day_column)


def stage_folder(
    spark: SparkSession, written: str, table: str, day: dt.date, schema: T.StructType, day_column: str = DAY
) -> Staged:
    """`stage` for rows that another write has left in a folder of the same file system: it is renamed."""
    folder = _run_folder(day, day_column)
    files.move(spark, written, f"{table}/{folder}")
    return Staged(table, day, folder, schema, day_column)


def rows_of(spark: SparkSession, staged: Staged) -> DataFrame:
    return spark.read.schema(staged.schema).parquet(f"{staged.table}/{staged.folder}")


def promote(spark: SparkSession, *staged: Staged, forget_before: dt.date | None = None) -> int:
    """Make staged days of one table its days, all at once; returns the commit's number.

    Days before `forget_before` are days of the table no longer; `vacuum` then removes their rows.

    Of two writers at once the second sees the commit of the first and adds to it; of the same day the last
    one stays. Days that were written as plain folders before the first commit remain days of the table.
    """
    table, day_column = staged[0].table, staged[0].day_column
    while True:
        last = newest(spark, table)
        if last is None:
            plain = plain_days_with_files(spark, table, day_column)
            last = Commit(0, _plain_schema(spark, table, plain, day_column), plain, day_column)
        if last.day_column != day_column:
            raise ValueError(f"{table} has its days in {last.day_column}, not {day_column}")
        schema = last.schema
        for part in staged:
            schema = merged(schema, part.schema)
        days = last.days | {part.day: part.folder for part in staged}
        days = {day: folder for day, folder in days.items() if forget_before is None or day >= forget_before}
        note = {
            "day_column": day_column,
            "schema": json.loads(schema.json()),
            "days": {day.isoformat(): days[day] for day in sorted(days)},
        }
        if files.publish(spark, f"{table}/{LOG}/{last.version + 1:010d}.json", json.dumps(note)):
            return last.version + 1


def plain_days_with_files(spark: SparkSession, table: str, day_column: str = DAY) -> dict[dt.date, str]:
    """Days whose folder itself holds files, not only runs that were never promoted."""
    return {day: f for day, f in plain_days(spark, table, day_column).items() if holds_files(spark, f"{table}/{f}")}


def holds_files(spark: SparkSession, folder: str) -> bool:
    return any(not name.startswith(("_", ".")) for name in files.names(spark, folder))


def _plain_schema(spark: SparkSession, table: str, days: dict[dt.date, str], day_column: str) -> T.StructType:
    if not days:
        return T.StructType([])
    fields = spark.read.option("mergeSchema", True).parquet(table).schema
    return T.StructType([f for f in fields if f.name != day_column])


def discard(spark: SparkSession, staged: Staged) -> None:
    """Delete staged rows, and the folders of day and table if nothing else is in them."""
    _clear(spark, staged.table, staged.folder)


def _clear(spark: SparkSession, table: str, folder: str) -> None:
    files.remove(spark, f"{table}/{folder}")
    files.remove_empty(spark, f"{table}/{folder.split('/')[0]}", table)


def read(
    spark: SparkSession, table: str, commit: Commit, days: Iterable[dt.date], schema: T.StructType | None = None
) -> DataFrame:
    """The given days of a commit, with the day as a column. Neither footers nor other folders are read."""
    fields = T.StructType(list((schema or commit.schema).fields)).add(commit.day_column, "date")
    folders = [f"{table}/{commit.days[day]}" for day in sorted(set(days)) if day in commit.days]
    if not folders:
        return spark.createDataFrame([], fields)
    return spark.read.schema(fields).option("basePath", table).parquet(*folders)


def vacuum(spark: SparkSession, table: str, keep: int = 2, older_than: float = 86_400.0) -> list[str]:
    """Delete run folders that none of the last `keep` commits names, and older commits; returns the folders.

    Folders changed within the last `older_than` seconds stay, since a run may still be writing them or a
    reader of an older commit reading them.
    """
    numbers = [n for n in files.names(spark, f"{table}/{LOG}") if n.endswith(".json") and not n.startswith(".")]
    if not numbers:
        return []
    last = [_commit(spark, table, name) for name in numbers[-keep:]]
    kept = {folder for commit in last for folder in commit.days.values()}
    gone = []
    for folder in plain_days(spark, table, last[-1].day_column).values():
        for name, age in files.ages(spark, f"{table}/{folder}").items():
            if name.startswith("_") and f"{folder}/{name}" not in kept and age >= older_than:
                files.remove(spark, f"{table}/{folder}/{name}")
                gone.append(f"{folder}/{name}")
    for name in numbers[:-keep]:
        files.remove(spark, f"{table}/{LOG}/{name}")
    return gone
