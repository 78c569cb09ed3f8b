"""Times each rewritten operator against its literal composition, on the same model tables.

Runs twice: with joins as Spark plans them, where the small tables are broadcast, and with
broadcasts off, which is how tables beyond the broadcast threshold are joined. The model tables
(order, consumer, restaurant, status, cart) are written once to the shared work folder, so that
neither form pays for deriving them. Prints one JSON line per pair.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import driver_tables as t
from bench import session
from daylake import operators as ops
from daylake import plans, sources
from daylake.functions import hash_columns, mask_linear
from daylake.operators import nested
from daylake.operators.statuses import STEPS
from driver_queries import RUN_DATE, SALT

WARM_UPS = 3
DAY_BEFORE = RUN_DATE.replace(day=RUN_DATE.day - 1)


@F.udf
def masked_by_row(number):
    return None if number is None else str(int(number) * 5 / 2)


#: Raw days of the incremental pair, the run's own included.
RAW_DAYS = 3


def literal_statuses(m) -> DataFrame:
    """One left join per step on a filtered scan, then distinct over the wide rows."""
    out = m["order"].select("order_id")
    for k, name in enumerate(STEPS, 1):
        of_step = (
            m["status"]
            .filter(F.col("status_value") == name)
            .select(
                "order_id",
                F.col("status_value").alias(f"status_{k}"),
                F.col("status_created_at").alias(f"status_created_at_{k}"),
            )
        )
        out = out.join(of_step, "order_id", "left")
    return out.dropDuplicates()


def literal_trusted_order(m) -> DataFrame:
    """Distinct before the rank, every join before the choice, and a row UDF for the mask."""
    masked = masked_by_row("customer_phone_number")
    consumers = m["consumer"].withColumn("customer_phone_number", masked)
    full = plans.orders_with_consumers(m["order"], consumers)
    full = plans.orders_with_merchants(full, m["restaurant"])
    chosen = ops.latest(full.dropDuplicates(), "customer_id", "order_created_at", ["order_id"])
    last = ops.latest(m["status"].dropDuplicates(), "order_id", "status_created_at", ["status_value"])
    return hash_columns(chosen.join(last, "order_id"), ["cpf"], SALT)


def literal_order_items(m) -> DataFrame:
    """Ids exploded next to the whole garnish array, which is then exploded once per id."""
    rows = (
        ops.parse_items(m["cart"])
        .select("order_id", F.explode("items").alias("item"))
        .select(
            "order_id",
            *nested._item_columns(),
            F.explode("item.garnishItems.externalId").alias("garnish_external_id"),
            F.col("item.garnishItems").alias("garnishes"),
        )
        .dropDuplicates()
    )
    garnishes = (
        rows.select("order_id", F.explode("garnishes").alias("garnish"))
        .select("order_id", *nested._garnish_columns())
        .dropDuplicates()
    )
    return rows.join(garnishes, ["order_id", "garnish_external_id"]).drop("garnishes")


def literal_gated_write(df: DataFrame, path: str) -> None:
    """Count, compare, and run the plan again to write it."""
    previous = previous_count(df, path)
    if ops.passes_gate(df.count(), previous):
        sources.write_day(df, path, RUN_DATE, "partition", files=30)


def raw_days(spark: SparkSession, m: dict, base: str) -> dict:
    """The model tables as raw days: a hundredth of the rows on the run's day, the others on the days before."""
    zones = {"raw": f"{base}/raw", "trusted": f"{base}/trusted"}
    names = {"status_created_at": "created_at", "status_value": "value"}
    for name, key in (("order", "order_id"), ("status", "order_id"), ("consumer", "customer_id"), ("restaurant", "id")):
        df = m[name].withColumnsRenamed(names if name == "status" else {})
        back = F.when(F.pmod(F.xxhash64(key), F.lit(100)) == 0, 0).otherwise(
            1 + F.pmod(F.xxhash64(key, F.lit(1)), F.lit(RAW_DAYS - 1))
        )
        day = F.date_sub(F.lit(RUN_DATE), back.cast("int"))
        sources.write_by_day(df, sources.zone_path(zones, "raw", name), day, "partition_column")
        plans.registry(spark, zones).declare(name, df.schema)
    return zones


def previous_count(df: DataFrame, path: str) -> int:
    return df.sparkSession.read.parquet(f"{path}/partition={DAY_BEFORE}").count()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    repeats = int(os.environ.get("BENCH_RUNS", "5"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    base = f"{sources.work_dir(spark)}/baseline/{uuid.uuid4().hex}"
    model = {}
    builders = {
        "order": t.orders,
        "consumer": t.consumers,
        "restaurant": t.merchants,
        "status": t.status,
        "cart": t.carts,
    }
    for name, build in builders.items():
        build(spark, sf_dir).repartition(8).write.parquet(f"{base}/{name}")
        model[name] = spark.read.parquet(f"{base}/{name}")
    m = model

    def trusted():
        masked = mask_linear("customer_phone_number")
        consumers = m["consumer"].withColumn("customer_phone_number", masked)
        return plans.trusted_order(
            m["order"], consumers, m["restaurant"], m["status"], RUN_DATE, SALT
        )

    gated = {form: f"{base}/{form}/order" for form in ("literal", "rewritten")}
    sources.write_day(trusted().drop("partition"), gated["literal"], DAY_BEFORE, "partition")
    sources.write_gated(trusted().drop("partition"), gated["rewritten"], DAY_BEFORE)

    zones = {form: raw_days(spark, m, f"{base}/{form}") for form in ("all", "new")}
    for k in reversed(range(1, RAW_DAYS)):
        plans.refresh_orders(spark, zones["new"], RUN_DATE - dt.timedelta(days=k), SALT, incremental=True)
    spark.sql("CREATE DATABASE IF NOT EXISTS baseline")
    plans.publish_colocated(m["order"], m["status"], f"{base}/by_id", RUN_DATE, 8, "baseline")
    last = ops.latest(m["status"], "order_id", "status_created_at", ["status_value"])
    last.repartition(8).write.parquet(f"{base}/last_status")
    last = spark.read.parquet(f"{base}/last_status")
    keys = ["order_id", "customer_id"]

    def compute(build):
        return lambda: build().write.format("noop").mode("overwrite").save()

    pairs = {
        "order_statuses": (
            compute(lambda: literal_statuses(m)),
            compute(lambda: ops.status_table(m["order"], m["status"])),
        ),
        "trusted_order": (compute(lambda: literal_trusted_order(m)), compute(trusted)),
        "order_items": (
            compute(lambda: literal_order_items(m)),
            compute(lambda: ops.order_items(m["cart"])),
        ),
        "gated_write_pass": (
            lambda: literal_gated_write(literal_trusted_order(m), gated["literal"]),
            lambda: sources.write_gated(trusted().drop("partition"), gated["rewritten"], RUN_DATE),
        ),
        "refresh_orders": (
            lambda: plans.refresh_orders(spark, zones["all"], RUN_DATE, SALT, all_raw_days=True),
            lambda: plans.refresh_orders(spark, zones["new"], RUN_DATE, SALT, incremental=True),
        ),
        "orders_status_colocated": (
            compute(lambda: m["order"].join(last, "order_id")),
            compute(lambda: plans.orders_with_last_status(spark, RUN_DATE, "baseline")),
        ),
        "table_profile": (
            compute(lambda: m["order"].agg(F.count("*"), *[F.count_distinct(k) for k in keys])),
            compute(lambda: ops.profile(m["order"], keys, dense=keys)),
        ),
    }
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for joins, threshold in (("as planned", default), ("shuffled", "-1")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name, (literal, rewritten) in pairs.items():
            seconds = {"literal": [], "rewritten": []}
            # Alternating runs, the first of them not counted: both forms see the same warm JVM.
            for run in range(WARM_UPS + repeats):
                for form, action in (("literal", literal), ("rewritten", rewritten)):
                    start = time.perf_counter()
                    action()
                    if run >= WARM_UPS:
                        seconds[form].append(time.perf_counter() - start)
            seconds = {form: round(statistics.median(s), 2) for form, s in seconds.items()}
            print(json.dumps({"query": name, "joins": joins, **seconds}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
