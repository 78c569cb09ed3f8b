"""Trusted orders: the newest order per customer with consumer, merchant and latest status."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daylake.functions.privacy import hash_columns
from daylake.operators.latest import latest, may_be_latest, one_per_key
from daylake.sources.writers import stamp


def orders_with_consumers(orders: DataFrame, consumers: DataFrame) -> DataFrame:
    """Inner join on the shared key name; the key appears once."""
    return orders.join(consumers, "customer_id")


def orders_with_merchants(orders: DataFrame, merchants: DataFrame) -> DataFrame:
    """Inner join on keys of different names; both stay."""
    o, m = orders.alias("o"), merchants.alias("m")
    return o.join(m, F.col("m.id") == F.col("o.merchant_id"))


def trusted_order(
    orders: DataFrame,
    consumers: DataFrame,
    merchants: DataFrame,
    status: DataFrame,
    run_date: dt.date,
    salt: str,
    hashed: Sequence[str] = ("cpf",),
    key: str = "customer_id",
    newest: str = "order_created_at",
    tie_break: Sequence[str] = ("order_id",),
    stored: bool = False,
) -> DataFrame:
    """Newest order of each `key` among the orders that have a consumer and a merchant.

    An order without one is passed over, not lost: the next older order of the key takes its
    place. The latest status comes after that choice, so a key whose chosen order has no status
    drops out. The columns in `hashed` are hashed last.

    Orders meet the merchants as a semi join before the choice, and the dimension columns are
    joined after it, to one row per key. A consumer is shared by all orders of a customer, so
    with `key="customer_id"` its existence needs no check before the choice. Dimensions that
    repeat a key are reduced to one row, as the choice per key would do.

    `stored=True` says that orders are cheap to read twice. Those that cannot be chosen are then dropped by
    their key, time and tie-break before whole orders, with their documents, are shuffled.
    """
    if stored:
        orders = may_be_latest(orders, linked_orders(orders, consumers, merchants, key), key, newest, tie_break)
    chosen = latest(linked_orders(orders, consumers, merchants, key), key, newest, tie_break)
    return completed(
        chosen,
        one_per_key(consumers, "customer_id"),
        one_per_key(merchants, "id"),
        last_status(status),
        run_date,
        salt,
        hashed,
    )


def linked_orders(orders: DataFrame, consumers: DataFrame, merchants: DataFrame, key: str) -> DataFrame:
    """Orders that have a merchant and may have a consumer: the rows among which the newest is chosen."""
    known = merchants.select(F.col("id").alias("merchant_id"))
    linked = orders.filter("customer_id IS NOT NULL").join(known, "merchant_id", "left_semi")
    if key != "customer_id":
        linked = linked.join(consumers.select("customer_id"), "customer_id", "left_semi")
    return linked


def last_status(status: DataFrame) -> DataFrame:
    """The latest status row of each order."""
    ranked = latest(status, "order_id", "status_created_at", ["status_value"])
    return ranked.select("order_id", "status_created_at", "status_value")


def completed(
    chosen: DataFrame,
    consumers: DataFrame,
    merchants: DataFrame,
    last: DataFrame,
    run_date: dt.date,
    salt: str,
    hashed: Sequence[str] = ("cpf",),
) -> DataFrame:
    """Chosen orders with the columns of their consumer, merchant and latest status; each of these holds a key once."""
    full = orders_with_merchants(orders_with_consumers(chosen, consumers), merchants)
    return hash_columns(stamp(full.join(last, "order_id"), run_date), hashed, salt)
