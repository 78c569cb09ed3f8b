"""Finding the keys that hold too many rows for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Below this many rows a key is never worth splitting.
HOT_ROWS = 100_000
# Keys are dealt into BUCKETS; a sketch of each follows TRACKED of them and names the LISTED most frequent.
# A key that holds more than 3.5 / TRACKED of its bucket's rows is named for certain, and there are at
# most BUCKETS * LISTED names: the bound that makes broadcasting them safe.
BUCKETS, TRACKED, LISTED = 64, 2_048, 512


def hot_items(rows: DataFrame, item: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(item, rows) of the values of `item` that hold more than `hot_rows` rows by a mergeable sketch.

    Each task sketches its rows during the scan and sends a few thousand counters for each bucket, however
    many values there are; counts are estimates. Buckets are merged side by side.
    """
    sketch = F.expr(f"approx_top_k(item, {LISTED}, {TRACKED})")
    return (
        rows.select(item.alias("item"))
        .groupBy(F.pmod(F.xxhash64("item"), F.lit(BUCKETS)).alias("bucket"))
        .agg(sketch.alias("top"))
        .select(F.explode("top").alias("top"))
        .select(F.col("top.item").alias("item"), F.col("top.count").alias("rows"))
        .filter(F.col("rows") > hot_rows)
    )


def salt_count(rows: Column, hot_rows: int = HOT_ROWS) -> Column:
    """Number of pieces to cut a hot key into."""
    return F.ceil(rows / F.lit(hot_rows)).cast("int")
