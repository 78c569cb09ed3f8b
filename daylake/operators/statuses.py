"""Status history of each order laid out in one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daylake.operators.skew import HOT_ROWS, hot_items, salt_count

# The status steps in the order of their output columns.
STEPS = ("REGISTERED", "PLACED", "CONCLUDED", "CANCELLED")

def _entries(status: DataFrame, steps: Sequence[str]) -> DataFrame:
    """Status rows of the steps, each step as its place in the list."""
    step = F.lit(None).cast("int")
    for k, name in enumerate(steps, 1):
        step = F.when(F.col("status_value") == name, F.lit(k)).otherwise(step)
    return status.filter(F.col("status_value").isin(*steps)).select(
        "order_id", step.alias("step"), F.col("status_created_at").alias("at")
    )


def status_table(
    orders: DataFrame,
    status: DataFrame,
    steps: Sequence[str] = STEPS,
    chained: bool = False,
    gather: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per order and combination of its distinct status entries, one entry per step.

    Columns `status_k` and `status_created_at_k` follow `steps`; a step an order never reached is
    null. Entries that repeat a step multiply the rows of the order. With `chained=True` the
    first step must exist and each later step counts only if the one before it was reached.

    Orders with more than `hot_rows` entries of a step are found by a sketch within the plan, and cut into pieces:
    the entries of that step are dealt to the pieces, the others are repeated in each. Every piece of an order is
    gathered and laid out inside its row, or joined with the entries of each step if `gather` is off. Which
    orders are cut has no effect on the rows. No job runs while the plan is built.
    """
    ids = orders.select("order_id").dropDuplicates()
    entries = _entries(status, steps)
    if gather:
        return _named(_gathered(ids, entries, steps, chained, _hot_orders(entries, hot_rows)), steps)
    distinct = _distinct(entries)
    return _named(_joined(ids, distinct, steps, chained, _hot_orders(distinct, hot_rows)), steps)


def _named(laid_out: DataFrame, steps: Sequence[str]) -> DataFrame:
    columns = ["order_id"]
    for k, name in enumerate(steps, 1):
        columns.append(F.when(F.col(f"e_{k}").isNotNull(), F.lit(name)).alias(f"status_{k}"))
        columns.append(F.col(f"e_{k}.at").alias(f"status_created_at_{k}"))
    return laid_out.select(*columns)


def _distinct(entries: DataFrame) -> DataFrame:
    # `present` is an aggregate result: a filter on it stays above the shuffle, which all steps
    # then share.
    return (
        entries.groupBy("order_id", "step", "at")
        .agg(F.max("step").alias("present"))
        .select("order_id", F.col("present").alias("step"), "at")
    )


def _gathered(
    ids: DataFrame, entries: DataFrame, steps: Sequence[str], chained: bool, hot: DataFrame
) -> DataFrame:
    """Orders with the entries of each step, gathered in one shuffle."""
    ids, entries = _in_pieces(ids, entries, hot)
    # A set is formed before the shuffle already, so copies of an entry do not travel.
    history = entries.groupBy("order_id", "piece").agg(F.collect_set(F.struct("step", "at")).alias("entries"))
    places = range(1, len(steps) + 1)
    # The arrays are columns of their own before the first explode, which keeps the explodes in
    # generated code.
    out = ids.join(history, ["order_id", "piece"], "inner" if chained else "left").select(
        "order_id", "piece", "split", *[_entries_of(k).alias(f"entries_{k}") for k in places]
    )
    for k in places:
        of_step = F.col(f"entries_{k}")
        if chained and k > 1:
            of_step = F.when(F.col(f"e_{k - 1}").isNotNull(), of_step)
        generator = F.explode if chained and k == 1 else F.explode_outer
        out = out.withColumn(f"e_{k}", generator(of_step)).drop(f"entries_{k}")
        out = _whole_pieces(out, k, chained)
    return out


def _entries_of(step: int) -> Column:
    return F.filter("entries", lambda e: e["step"] == step)


def _hot_orders(entries: DataFrame, hot_rows: int) -> DataFrame:
    """(key, split, pieces) of hot orders: the id as text, the step to split and the number of pieces.

    Only the step with most entries is split. A result row takes one entry of each step, so an
    order has at least as many result rows as the product of its two largest steps: the second
    largest is small wherever the result can be written at all.
    """
    found = hot_items(entries, F.concat("step", F.lit(":"), F.col("order_id").cast("string")), hot_rows)
    step = F.substring_index("item", ":", 1).cast("int")
    key = F.expr("substring(item, instr(item, ':') + 1)")
    largest = found.groupBy(key.alias("key")).agg(F.max(F.struct("rows", step.alias("split"))).alias("largest"))
    return F.broadcast(
        largest.select("key", "largest.split", salt_count(F.col("largest.rows"), hot_rows).alias("pieces"))
    )


def _in_pieces(ids: DataFrame, entries: DataFrame, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders once for each piece, and entries with theirs. Entries of the split step are spread over the
    pieces; the order and its other entries are repeated in each."""
    every_piece = F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)
    own_piece = F.array(F.pmod(F.xxhash64("at"), F.col("pieces")).cast("int"))
    piece = F.when(F.col("split") == F.col("step"), own_piece).otherwise(every_piece)

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("key", F.col("order_id").cast("string")).join(hot, "key", "left")

    return (
        keyed(ids).select("order_id", F.explode(every_piece).alias("piece"), "split"),
        keyed(entries).select("order_id", F.explode(piece).alias("piece"), "step", "at"),
    )


def _whole_pieces(out: DataFrame, k: int, chained: bool) -> DataFrame:
    """Without rows of pieces that received no entry of the split step `k`, of which the result has none.

    In a chain the step may be out of reach of the whole order; its rows are then the same in every piece, and
    those of the first stay.
    """
    kept = F.coalesce(F.col("split") != k, F.lit(True)) | F.col(f"e_{k}").isNotNull()
    if chained and k > 1:
        kept = kept | (F.col(f"e_{k - 1}").isNull() & (F.col("piece") == 0))
    return out.filter(kept)


def _joined(
    ids: DataFrame, entries: DataFrame, steps: Sequence[str], chained: bool, hot: DataFrame
) -> DataFrame:
    """Orders joined with the entries of each step. `entries` are distinct, so the rows are as well."""
    keys = ["order_id", "piece"]
    out, entries = _in_pieces(ids, entries, hot)
    for k in range(1, len(steps) + 1):
        of_step = entries.filter(F.col("step") == k).select(*keys, F.struct("at").alias(f"e_{k}"))
        if chained and k > 1:
            reached = F.col(f"e_{k - 1}").isNotNull()
            left, right = out.alias("l"), of_step.alias("r")
            on = reached
            for key in keys:
                on = on & (F.col(f"l.{key}") == F.col(f"r.{key}"))
            out = left.join(right, on, "left").select("l.*", f"e_{k}")
        else:
            out = out.join(of_step, keys, "inner" if chained else "left")
        out = _whole_pieces(out, k, chained)
    return out


def status_funnel(
    orders: DataFrame, status: DataFrame, steps: Sequence[str] = STEPS, **options
) -> DataFrame:
    """`status_table` with each step chained to the one before it."""
    return status_table(orders, status, steps, chained=True, **options)


def latest_statuses(orders: DataFrame, status: DataFrame, steps: Sequence[str] = STEPS) -> DataFrame:
    """One row per order: the latest time of each step. One scan, one aggregate, one join."""
    reached = status.filter(F.col("status_value").isin(*steps)).groupBy("order_id").agg(
        *[
            c
            for k, s in enumerate(steps, 1)
            for c in (
                F.max(F.when(F.col("status_value") == s, F.lit(1))).alias(f"has_{k}"),
                F.max(F.when(F.col("status_value") == s, F.col("status_created_at"))).alias(
                    f"status_created_at_{k}"
                ),
            )
        ]
    )
    out = orders.select("order_id").dropDuplicates().join(reached, "order_id", "left")
    return out.select(
        "order_id",
        *[
            c
            for k, s in enumerate(steps, 1)
            for c in (
                F.when(F.col(f"has_{k}") == 1, F.lit(s)).alias(f"status_{k}"),
                F.col(f"status_created_at_{k}"),
            )
        ],
    )
