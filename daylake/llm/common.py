"""What the operators of this package share: tables, the shared folder, Arrow columns."""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Iterable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parents[2]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it.

    It covers sessions started before the library was put on their path. On a cluster the library
    is installed on the executors or sent with `--py-files`.
    """
    environment = spark.sparkContext.environment
    path = environment.get("PYTHONPATH", "")
    if str(ROOT) not in path.split(":"):
        environment["PYTHONPATH"] = f"{ROOT}:{path}".rstrip(":")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors reach: below `spark.checkpoint.dir`.

    Where that is unset, as in tests, the session's warehouse takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back, which cuts its lineage."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """As `stored`, bucketed by `key`: groups and joins by it read the table without shuffling it.

    The catalog knows the table only until it has been opened.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, key).saveAsTable(table)
    kept = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return kept


def packed_numbers(values: np.ndarray) -> bytes:
    """Numbers as planes of equal bytes, compressed: planes of zeros take no room."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked_numbers(data: bytes, kind: str) -> np.ndarray:
    size, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], size * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, size).T).view(kind).ravel()


def as_list(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Values of a binary column, faster than one scalar after the other."""
    column = column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)
    return column.tolist()


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [pa.array(c, type=f.type, from_pandas=False) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class Taken:
    """Stretches of a text that are taken, as disjoint intervals in order."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        """Whether a taken place lies from `start` up to `end`."""
        last = bisect_left(self.starts, end) - 1
        return last >= 0 and self.ends[last] > start

    def add(self, start: int, end: int) -> None:
        """Take a stretch that meets none so far."""
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)
