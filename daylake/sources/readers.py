"""Scans of source files, raw days and trusted days."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daylake.functions.privacy import mask_linear
from daylake.sources import commits
from daylake.sources.commits import DAY

RAW_DAY = "partition_column"


class Days(NamedTuple):
    """The days after one up to another, which counts; without the first, all up to the other."""

    after: dt.date | None
    upto: dt.date

    def __contains__(self, day: object) -> bool:
        return isinstance(day, dt.date) and day <= self.upto and (self.after is None or day > self.after)

    def where(self, column: str) -> Column:
        until = F.col(column) <= F.lit(self.upto)
        return until if self.after is None else until & (F.col(column) > F.lit(self.after))


def read_source(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | None = None,
    infer: bool = False,
    corrupt: str | None = None,
) -> DataFrame:
    """CSV with a header row, or JSON lines; gzip is recognized by the file name.

    Without a schema, CSV columns are strings and JSON cannot be read, unless `infer=True` lets
    an extra pass over the files look for columns and types. A record that does not fit the schema gives
    nulls; `corrupt` names a column that holds the text of such records, and null for all others.
    """
    if fmt not in ("csv", "json"):
        raise ValueError(f"no source reader for {fmt!r}")
    if fmt == "json" and schema is None and not infer:
        raise ValueError("JSON needs a schema, or infer=True for an extra pass over the files")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", infer)
    if corrupt is not None:
        if schema is None:
            raise ValueError("without a schema there is nothing that a record does not fit")
        schema = StructType(list(schema.fields)).add(corrupt, "string")
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def scan(
    spark: SparkSession,
    path: str,
    day: dt.date | Days | None = None,
    day_column: str = DAY,
    schema: StructType | None = None,
) -> DataFrame:
    """Parquet table with day partitions: every day, one day, or a range of days.

    Of a table with commits the folders that the newest one names are read, with its schema unless another is
    given. Else days are pruned by folder; with a declared `schema` (without the day) no footer is read to plan,
    otherwise the columns of all days are merged. A column that a day lacks is its default or null there.
    """
    commit = commits.newest(spark, path)
    if commit is not None:
        wanted = [d for d in commit.days if day is None or (d in day if isinstance(day, Days) else d == day)]
        return commits.read(spark, path, commit, wanted, schema)
    if schema is not None:
        df = spark.read.schema(StructType(list(schema.fields)).add(day_column, "date")).parquet(path)
    else:
        df = spark.read.option("mergeSchema", True).parquet(path)
    if day is None:
        return df
    return df.filter(day.where(day_column) if isinstance(day, Days) else F.col(day_column) == F.lit(day))


def _raw(spark: SparkSession, path: str, day: dt.date | Days | None, schema: StructType | None) -> DataFrame:
    return scan(spark, path, day, RAW_DAY, schema).drop(RAW_DAY)


def raw_orders(
    spark: SparkSession, path: str, day: dt.date | Days | None = None, schema: StructType | None = None
) -> DataFrame:
    return _raw(spark, path, day, schema).drop("customer_name")


def raw_status(
    spark: SparkSession, path: str, day: dt.date | Days | None = None, schema: StructType | None = None
) -> DataFrame:
    return _raw(spark, path, day, schema).withColumnsRenamed(
        {"created_at": "status_created_at", "value": "status_value"}
    )


def raw_consumers(
    spark: SparkSession, path: str, day: dt.date | Days | None = None, schema: StructType | None = None
) -> DataFrame:
    """Consumers without the name, with the phone number masked."""
    return (
        _raw(spark, path, day, schema)
        .drop("customer_name")
        .withColumnRenamed("created_at", "consumer_created_at")
        .withColumn("customer_phone_number", mask_linear("customer_phone_number"))
    )


def raw_merchants(
    spark: SparkSession, path: str, day: dt.date | Days | None = None, schema: StructType | None = None
) -> DataFrame:
    return _raw(spark, path, day, schema).withColumnRenamed("created_at", "restaurant_created_at")


def file_inventory(
    spark: SparkSession, path: str, pattern: str = "*", prefix: str = "", suffix: str = ""
) -> DataFrame:
    """Files below a path with size and time, filtered by glob, key prefix and key suffix.

    The key is the path below `path`; `dataset` is its first level. File contents are not read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length", "modificationTime")
    )
    base = path.split(":", 1)[-1].strip("/")
    key = F.split_part("path", F.lit(base + "/"), F.lit(-1))
    return (
        files.withColumn("key", key)
        .filter(F.col("key").startswith(prefix) & F.col("key").endswith(suffix))
        .withColumn("dataset", F.split_part("key", F.lit("/"), F.lit(1)))
    )


def latest_day_before(
    spark: SparkSession, path: str, day: dt.date, day_column: str = DAY
) -> dt.date | None:
    """Newest day of a table before `day`; None if the table or such a day does not exist.

    The newest commit names the days; without one, folder names are listed, one per day, and the newest
    folder that holds files counts.
    """
    commit = commits.newest(spark, path)
    if commit is not None:
        return max((d for d in commit.days if d < day), default=None)
    folders = commits.plain_days(spark, path, day_column)
    earlier = sorted((d for d in folders if d < day), reverse=True)
    return next((d for d in earlier if commits.holds_files(spark, f"{path}/{folders[d]}")), None)


def count_day(spark: SparkSession, path: str, day: dt.date) -> int | None:
    """Row count of one day from its file footers; None if it does not exist."""
    commit = commits.newest(spark, path)
    if commit is not None:
        return commits.read(spark, path, commit, [day]).count() if day in commit.days else None
    folder = f"{path}/{DAY}={day.isoformat()}"
    return spark.read.parquet(folder).count() if commits.holds_files(spark, folder) else None
