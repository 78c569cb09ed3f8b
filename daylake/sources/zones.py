"""Where datasets live: a map from zone name to base path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

SOURCE = "source"


def zone_path(zones: Mapping[str, str], zone: str, name: str, fmt: str | None = None) -> str:
    """`base/name.fmt.gz` in the source zone, `base/name` in any other.

    A source base may hold a directory or a glob of that name; gzip files cannot be split, so
    large datasets should arrive as many files.
    """
    base = zones[zone].rstrip("/")
    if zone == SOURCE:
        if not fmt:
            raise ValueError("a source file needs a format")
        return f"{base}/{name}.{fmt}.gz"
    return f"{base}/{name}"


def work_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: the one the cluster names in `spark.checkpoint.dir`, and
    the session's warehouse where that is unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return shared.rstrip("/")
