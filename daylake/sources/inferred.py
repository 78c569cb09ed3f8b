"""Schemas of document columns, inferred a day at a time: one note per day, merged without reading texts again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daylake.operators.nested import infer_items_schema
from daylake.sources import files

_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def combined(old: T.DataType, new: T.DataType) -> T.DataType:
    """The type of documents of either; what has no common type is a variant, which holds any value.

    Structs keep the fields of both, by name in order. Numbers widen: whole ones to the wider, with decimals
    to a decimal that holds both or else a double, with floating ones to a double. Nothing and anything is
    anything.
    """
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        fields = {f.name: f.dataType for f in old}
        for f in new:
            fields[f.name] = combined(fields[f.name], f.dataType) if f.name in fields else f.dataType
        return T.StructType([T.StructField(name, fields[name]) for name in sorted(fields)])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(combined(old.elementType, new.elementType))
    if isinstance(old, T.NumericType) and isinstance(new, T.NumericType):
        return _number(old, new)
    return T.VariantType()


def _number(old: T.NumericType, new: T.NumericType) -> T.DataType:
    if isinstance(old, T.FractionalType) and not isinstance(old, T.DecimalType):
        return T.DoubleType()
    if isinstance(new, T.FractionalType) and not isinstance(new, T.DecimalType):
        return T.DoubleType()
    if not isinstance(old, T.DecimalType) and not isinstance(new, T.DecimalType):
        return max(old, new, key=lambda t: _DIGITS[type(t)])
    sizes = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (old, new)]
    whole, scale = max(w for w, _ in sizes), max(s for _, s in sizes)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


class InferredSchemas:
    """The schema of a document column, kept per day in a folder of small files."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def days(self) -> dict[dt.date, T.DataType]:
        """What is kept, by day."""
        found = [n for n in files.names(self.spark, self.path) if n.endswith(".ddl") and not n.startswith(".")]
        return {
            dt.date.fromisoformat(name[: -len(".ddl")]): T.DataType.fromDDL(files.read_text(self.spark, f"{self.path}/{name}"))
            for name in found
        }

    def schema(
        self,
        days: Iterable[dt.date],
        read_day: Callable[[dt.date], DataFrame],
        column: str = "items",
        anew: Iterable[dt.date] = (),
    ) -> T.DataType:
        """The schema of all documents of `days`. Texts are read, once, of the days that are not kept yet.

        `anew` names days that were written again since; they are read again. Days without a document that
        parses add nothing; if none has one, the type is null.
        """
        again = set(anew)
        for day in again:
            files.remove(self.spark, f"{self.path}/{day.isoformat()}.ddl")
        kept, whole = self.days(), T.NullType()
        for day in sorted(set(days)):
            if day not in kept:
                kept[day] = infer_items_schema(read_day(day), column)
                files.publish(self.spark, f"{self.path}/{day.isoformat()}.ddl", kept[day].simpleString())
            whole = combined(whole, kept[day])
        return whole
