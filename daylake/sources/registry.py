"""Declared schemas: one per dataset, in versions that only ever add or widen columns.

A scan with a declared schema reads no file footer to plan. Files written before a column was declared give
that column's default, or null.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from daylake.sources import files

#: Metadata by which Spark's file scans fill in a column that a file lacks: an SQL literal.
DEFAULT = "EXISTS_DEFAULT"

# For each type the wider ones that Spark reads its Parquet files as.
_WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.DateType: (T.TimestampNTZType,),
}


class SchemaConflict(ValueError):
    """A column whose old and new type have no common one."""


def widened(old: T.DataType, new: T.DataType, at: str = "column") -> T.DataType:
    """The narrowest type that reads both; structs are merged by field, elements and values by theirs."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merged(old, new, at)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widened(old.elementType, new.elementType, f"{at}[]"))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(
            widened(old.keyType, new.keyType, f"{at}.key"), widened(old.valueType, new.valueType, f"{at}.value")
        )
    if old == new or isinstance(old, _WIDER.get(type(new), ())):
        return old
    if isinstance(new, _WIDER.get(type(old), ())):
        return new
    # A column that only ever was null takes any type.
    if isinstance(old, T.NullType) or isinstance(new, T.NullType):
        return new if isinstance(old, T.NullType) else old
    raise SchemaConflict(f"{at}: {old.simpleString()} and {new.simpleString()}")


def merged(old: T.StructType, new: T.StructType, at: str = "") -> T.StructType:
    """Fields of both, the old ones first. Names are compared as Spark does, without case. All may be null."""
    known = {f.name.lower(): f for f in new}
    out = []
    for f in old:
        other = known.pop(f.name.lower(), None)
        kind = f.dataType if other is None else widened(f.dataType, other.dataType, f"{at}.{f.name}".lstrip("."))
        metadata = f.metadata if other is None or DEFAULT in f.metadata else {**other.metadata, **f.metadata}
        out.append(T.StructField(f.name, kind, True, metadata))
    return T.StructType(out + [T.StructField(f.name, f.dataType, True, f.metadata) for f in known.values()])


def with_defaults(schema: T.StructType, defaults: Mapping[str, str]) -> T.StructType:
    """`schema` with SQL literals for columns that older files lack."""
    unknown = set(defaults) - set(schema.names)
    if unknown:
        raise ValueError(f"defaults of unknown columns: {sorted(unknown)}")
    return T.StructType(
        [
            T.StructField(f.name, f.dataType, True, {**f.metadata, DEFAULT: defaults[f.name]}) if f.name in defaults else f
            for f in schema
        ]
    )


class Registry:
    """The schemas of the datasets of one zone, kept in a folder as one small file per version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self, dataset: str) -> list[int]:
        found = files.names(self.spark, f"{self.path}/{dataset}")
        return [int(name.split(".")[0]) for name in found if not name.startswith(".")]

    def schema(self, dataset: str, version: int | None = None) -> T.StructType | None:
        """The newest schema of a dataset, or that of one version; None if nothing is declared."""
        if version is None:
            version = max(self.versions(dataset), default=None)
            if version is None:
                return None
        text = files.read_text(self.spark, f"{self.path}/{dataset}/{version:08d}.json")
        return T.StructType.fromJson(json.loads(text))

    def declare(self, dataset: str, schema: T.StructType, defaults: Mapping[str, str] | None = None) -> int:
        """Merge `schema` into what is declared and return the version that holds it.

        A new version is written only if something changes. A column is never dropped: files that lack it
        read as its default or null. A type that does not fit the declared one raises SchemaConflict, and
        nothing is written. Of two writers at once one comes second and merges again.
        """
        schema = with_defaults(merged(schema, T.StructType([])), defaults or {})
        while True:
            known = self.schema(dataset)
            wanted = schema if known is None else merged(known, schema)
            version = max(self.versions(dataset), default=0)
            if known is not None and wanted == known:
                return version
            if files.publish(self.spark, f"{self.path}/{dataset}/{version + 1:08d}.json", wanted.json()):
                return version + 1
