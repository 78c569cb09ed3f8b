"""Trusted orders from what is new: the newest rows of all earlier days are kept as tables of their own.

Every choice in `trusted_order` takes the greatest row of a key in a total order, and the greatest of all rows is
the greatest of yesterday's greatest and today's rows. Four tables hold those: the chosen order of each key with
the orders that wait for a merchant, one consumer, one merchant, one status per key. A day reads them once, adds the
raw days since, and gives the same trusted orders as all raw days together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.operators.latest import latest, one_per_key
from daylake.plans.trusted_order import completed, linked_orders
from daylake.sources import commits
from daylake.sources.readers import Days, latest_day_before

#: Tables of the newest rows. A day that all of them have is a state.
ORDERS, CONSUMERS, MERCHANTS, STATUS = "order", "consumer", "restaurant", "status"
NAMES = (ORDERS, CONSUMERS, MERCHANTS, STATUS)
#: Days for which states are kept, so that a run can be done again from one of them.
KEPT_DAYS = 7


class Newest(NamedTuple):
    """The rows that later days still need."""

    order: DataFrame
    consumer: DataFrame
    restaurant: DataFrame
    status: DataFrame


def _both(before: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if before is None else before.unionByName(new, allowMissingColumns=True)


def newest_orders(
    orders: DataFrame,
    consumers: DataFrame,
    merchants: DataFrame,
    key: str = "customer_id",
    newest: str = "order_created_at",
    tie_break: Sequence[str] = ("order_id",),
) -> DataFrame:
    """The orders that later days still need, of those kept so far and new ones.

    Of each key's orders these are the newest that is linked, and those that are not linked yet and no older:
    a consumer or merchant that comes later may still let one of them win. Older ones never can.
    """
    orders = orders.filter("customer_id IS NOT NULL")
    chosen = latest(linked_orders(orders, consumers, merchants, key), key, newest, tie_break)
    bar = chosen.select(key, F.col(newest).alias("__bar"), F.lit(True).alias("__chosen"))
    waiting = (
        _unlinked(orders, consumers, merchants, key)
        .join(bar, key, "left")
        .filter(F.col("__chosen").isNull() | F.col("__bar").isNull() | (F.col(newest) >= F.col("__bar")))
        .select(orders.columns)
        .dropDuplicates()
    )
    return chosen.select(orders.columns).unionByName(waiting)


def _unlinked(orders: DataFrame, consumers: DataFrame, merchants: DataFrame, key: str) -> DataFrame:
    m = merchants.select(F.col("id").alias("merchant_id"), F.lit(True).alias("__merchant"))
    flagged = orders.join(m, "merchant_id", "left")
    missing = F.col("__merchant").isNull()
    if key != "customer_id":
        c = consumers.select("customer_id", F.lit(True).alias("__consumer"))
        flagged = flagged.join(c, "customer_id", "left")
        missing = missing | F.col("__consumer").isNull()
    return flagged.filter(missing).select(orders.columns)


def trusted_from(
    state: Newest,
    run_date: dt.date,
    salt: str,
    hashed: Sequence[str] = ("cpf",),
    key: str = "customer_id",
    newest: str = "order_created_at",
    tie_break: Sequence[str] = ("order_id",),
) -> DataFrame:
    """What `trusted_order` gives for all rows that the state stands for."""
    chosen = latest(linked_orders(state.order, state.consumer, state.restaurant, key), key, newest, tie_break)
    last = state.status.select("order_id", "status_created_at", "status_value")
    return completed(chosen, state.consumer, state.restaurant, last, run_date, salt, hashed)


def advance(
    spark: SparkSession,
    base: str,
    run_date: dt.date,
    read_new: Callable[[Days], Newest],
    **order: object,
) -> Newest:
    """Bring the state tables below `base` up to `run_date` and return that day's state.

    `read_new` gets the days that the last state before `run_date` does not hold: one, or all that were missed.
    A day counts as done once all four tables have it, so a run that ends early is done again, and so is
    a day that is run twice: both start from the state before it. Rows of a raw day that is delivered anew after
    its state was made come in when the state is made again from that day on.
    """
    last = _last_state(spark, base, run_date)
    before = Newest(*[None] * len(NAMES)) if last is None else _read(spark, base, last)
    new = read_new(Days(last, run_date))

    # Older states are needed by no run; the last one is, should this day be done again.
    oldest = run_date - dt.timedelta(days=KEPT_DAYS)
    oldest = oldest if last is None else min(last, oldest)

    def kept(name: str, rows: DataFrame) -> DataFrame:
        commits.promote(spark, commits.stage(rows, f"{base}/{name}", run_date), forget_before=oldest)
        return _read_one(spark, base, name, run_date)

    consumers = kept(CONSUMERS, one_per_key(_both(before.consumer, new.consumer), "customer_id"))
    merchants = kept(MERCHANTS, one_per_key(_both(before.restaurant, new.restaurant), "id"))
    ranked = latest(_both(before.status, new.status), "order_id", "status_created_at", ["status_value"])
    status = kept(STATUS, ranked)
    orders = kept(ORDERS, newest_orders(_both(before.order, new.order), consumers, merchants, **order))
    return Newest(orders, consumers, merchants, status)


def _last_state(spark: SparkSession, base: str, run_date: dt.date) -> dt.date | None:
    day = run_date
    while True:
        days = {latest_day_before(spark, f"{base}/{name}", day) for name in NAMES}
        if None in days:
            return None
        if len(days) == 1:
            return days.pop()
        # One table is ahead: only what all have is a state.
        day = min(days) + dt.timedelta(days=1)


def _read_one(spark: SparkSession, base: str, name: str, day: dt.date) -> DataFrame:
    table = f"{base}/{name}"
    return commits.read(spark, table, commits.newest(spark, table), [day]).drop(commits.DAY)


def _read(spark: SparkSession, base: str, day: dt.date) -> Newest:
    return Newest(*[_read_one(spark, base, name, day) for name in NAMES])


def state_path(zones: Mapping[str, str], zone: str) -> str:
    """Where the state tables of a zone are kept; not below its datasets, so that scans of them see none."""
    return f"{zones[zone].rstrip('/')}/_newest"
