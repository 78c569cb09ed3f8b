"""Row-count gate and validation reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

MAX_DROP_PERCENT = 80


def passes_gate(actual: int, previous: int, max_drop_percent: int = MAX_DROP_PERCENT) -> bool:
    """False when the count fell by `max_drop_percent` or more. Whole numbers, so no rounding."""
    return actual >= previous or 100 * (previous - actual) < max_drop_percent * previous


def distinct_values(df: DataFrame, key: str, dense: bool = False) -> DataFrame:
    """One row with the exact number of values of `key`, nulls not counted, as `values`.

    With `dense`, for whole numbers that lie close together, each task sends one bitmap of 4 KiB for every
    32,768 of them in place of the values. Numbers scattered over 64 bits would each have a bitmap of their own.
    """
    if not dense:
        return df.select(key).filter(F.col(key).isNotNull()).distinct().agg(F.count(F.lit(1)).alias("values"))
    if not isinstance(df.schema[key].dataType, IntegralType):
        raise ValueError(f"{key} holds no whole numbers")
    bitmaps = (
        df.filter(F.col(key).isNotNull())
        .groupBy(F.bitmap_bucket_number(key).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"))
    )
    return bitmaps.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0).cast("long")).alias("values"))


def profile(
    df: DataFrame, keys: Sequence[str], lengths: Sequence[str] = (), dense: Sequence[str] = ()
) -> DataFrame:
    """One row: row count, exact distinct count of each key, greatest length of each text.

    Each key is counted in a pass over its own column, so that no row is copied for the other keys; those in
    `dense` by bitmaps.
    """
    counts = [distinct_values(df, k, k in dense).scalar().alias(f"distinct_{k}") for k in keys]
    longest = [F.max(F.length(c)).alias(f"max_length_{c}") for c in lengths]
    whole = df.agg(F.count(F.lit(1)).alias("row_count"), *longest)
    return whole.select("row_count", *counts, *[f"max_length_{c}" for c in lengths])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter("count > 1")


def text_lengths(df: DataFrame, column: str) -> DataFrame:
    """Distinct lengths of a text column, with the greatest length and the rows of each."""
    lengths = df.select(F.length(column).alias("length"))
    return lengths.groupBy("length").agg(
        F.max("length").alias("max_length"), F.count(F.lit(1)).alias("count")
    )


def preview(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First `n` rows in a stated order, so that the preview can be repeated."""
    return df.orderBy(*order).limit(n)
