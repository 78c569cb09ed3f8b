"""Co-located tables: days bucketed and sorted by a key, so that joins and groupings by it need no shuffle.

A catalog table holds the layout; Spark reads bucket i of two tables with one bucket count, or with counts that
divide each other, in one task. The rows of a key are in one bucket, so the key should have few rows each, as
ids of snapshots have.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.sources.commits import DAY


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def create_colocated(
    spark: SparkSession, table: str, path: str, df: DataFrame, key: str, buckets: int, day_column: str = DAY
) -> None:
    """Create a table with the columns of `df` and days in `day_column`, unless it is there with this layout.

    A table of another key or bucket count raises: its files are laid out otherwise.
    """
    if spark.catalog.tableExists(table):
        found = layout(spark, table)
        if found != (key, buckets):
            raise ValueError(f"{table} has its rows by {found[0]} in {found[1]} buckets, not by {key} in {buckets}")
        return
    columns = [f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema if f.name != day_column]
    spark.sql(
        f"CREATE TABLE {table} ({', '.join(columns)}, {_quoted(day_column)} DATE) USING parquet"
        f" PARTITIONED BY ({_quoted(day_column)})"
        f" CLUSTERED BY ({_quoted(key)}) SORTED BY ({_quoted(key)}) INTO {buckets} BUCKETS"
        f" LOCATION '{path}'"
    )


def layout(spark: SparkSession, table: str) -> tuple[str, int]:
    """(key, buckets) of a table; ('', 0) if it has none."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    key = rows.get("Bucket Columns", "[]").strip("[]").replace("`", "")
    return key, int(rows.get("Num Buckets", "0"))


def write_colocated(
    df: DataFrame, table: str, path: str, run_date: dt.date, key: str, buckets: int, day_column: str = DAY
) -> None:
    """Write a day of a co-located table, replacing that day only: one shuffle, one sorted file for each bucket."""
    spark = df.sparkSession
    create_colocated(spark, table, path, df, key, buckets, day_column)
    columns = ", ".join(_quoted(c) for c in spark.table(table).columns if c != day_column)
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({_quoted(day_column)} = DATE '{run_date.isoformat()}')"
        f" SELECT {columns} FROM {{rows}}",
        rows=df.repartition(buckets, key),
    )


def read_colocated(spark: SparkSession, table: str, day: dt.date, day_column: str = DAY) -> DataFrame:
    """A day of a co-located table, without the day."""
    return spark.table(table).filter(F.col(day_column) == F.lit(day)).drop(day_column)
