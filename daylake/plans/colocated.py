"""Trusted orders and their statuses stored by order id: the daily joins run bucket by bucket."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from daylake.plans.trusted_order import last_status
from daylake.sources.buckets import read_colocated, write_colocated

ORDERS, STATUS = "orders_by_id", "last_status_by_id"


def publish_colocated(
    orders: DataFrame, status: DataFrame, path: str, run_date: dt.date, buckets: int, database: str = "default"
) -> None:
    """Write a day of orders and the latest status of each order, both bucketed and sorted by `order_id`."""
    write_colocated(orders, f"{database}.{ORDERS}", f"{path}/{ORDERS}", run_date, "order_id", buckets)
    write_colocated(last_status(status), f"{database}.{STATUS}", f"{path}/{STATUS}", run_date, "order_id", buckets)


def orders_with_last_status(spark: SparkSession, run_date: dt.date, database: str = "default") -> DataFrame:
    """Orders of a published day that have a status, with the latest one: a join without a shuffle."""
    orders = read_colocated(spark, f"{database}.{ORDERS}", run_date)
    return orders.hint("merge").join(read_colocated(spark, f"{database}.{STATUS}", run_date), "order_id")
