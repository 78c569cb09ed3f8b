"""Newest row per key and distinct rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(
    df: DataFrame, key: str | Sequence[str], newest: str, tie_break: Sequence[str]
) -> DataFrame:
    """The row of each key with the greatest `newest`, nulls last.

    `tie_break` names the columns that decide between rows of the same time, greatest first. All
    other columns follow it, so the order is total and the winner the same on every run. Spark plans the rank filter as a group limit on
    both sides of the shuffle: a task sends at most one row per key, however hot the key is.
    Exact copies need no prior `distinct`, since only one of them can rank first.
    """
    keys = [key] if isinstance(key, str) else list(key)
    named = [*keys, newest, *tie_break]
    rest = [c for c in df.columns if c not in named]
    order = [_orderable(df, c).desc_nulls_last() for c in (newest, *tie_break, *rest)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


#: Words of 64 bits that `may_be_latest` broadcasts at most: 8 MB of bits, about a million rows.
WORDS = 1 << 20


def may_be_latest(
    df: DataFrame, among: DataFrame, key: str | Sequence[str], newest: str, tie_break: Sequence[str], words: int = WORDS
) -> DataFrame:
    """The rows of `df` that `latest` could choose if it chose among the rows of `among`, and some others.

    For wide rows of a stored table, which is read twice: first only the columns that order the rows are shuffled,
    and the place of each key's greatest values is kept as one bit of `words` words. They are broadcast, so that
    tasks drop almost all other rows before anything wide is shuffled. The share of others that
    stay is that of the bits set: one in 12 at five million keys. It has no effect on what `latest` then returns.
    """
    named = [*([key] if isinstance(key, str) else key), newest, *tie_break]
    # The word is named by the lower bits of the hash, the bit in it by the upper six.
    place = F.xxhash64(*[_orderable(df, c) for c in named])
    word, bit = F.pmod(place, F.lit(words)).cast("int"), F.shiftrightunsigned(place, 58).cast("int")
    set_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    chosen = latest(among.select(*named), key, newest, tie_break)
    bits = chosen.groupBy(word.alias("__word")).agg(F.bit_or(set_bit).alias("__bits"))
    known = (word == F.col("__word")) & (F.getbit("__bits", bit) == 1)
    return df.join(F.broadcast(bits), known, "left_semi")


def _orderable(df: DataFrame, column: str) -> Column:
    # Maps cannot be compared, also within other types; their JSON can.
    kind = df.schema[column].dataType.simpleString()
    return F.to_json(F.struct(column)) if "map<" in kind or kind == "variant" else F.col(column)


def one_per_key(df: DataFrame, key: str, newest: str | None = None) -> DataFrame:
    """`latest` with every other column as the tie-break, for dimensions that may repeat a key."""
    rest = [c for c in df.columns if c not in (key, newest)]
    if newest is None:
        if not rest:
            return df.dropDuplicates([key])
        newest, *rest = rest
    return latest(df, key, newest, rest)


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, of all columns or of the named ones."""
    return (df.select(*columns) if columns else df).dropDuplicates()
