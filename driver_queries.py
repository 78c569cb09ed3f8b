"""One query per operator, over the driver's tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import driver_tables as t
from daylake import operators as ops
from daylake import plans, sources
from daylake.functions import hash_columns, local_day, mask_linear, salted_hash

RUN_DATE = dt.date(2024, 1, 31)
SALT = "test-salt"
# Documents take a sixth of their size on disk or less, and are slow to parse.
DOCUMENT_ROW_GROUP = 4 << 20


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{sources.work_dir(spark)}/queries/{uuid.uuid4().hex}/{name}"


# Scans, sources and sinks


def _source_file(spark: SparkSession, sf_dir: str, name: str, fmt: str, base: str) -> None:
    path = sources.zone_path({"source": base}, "source", name, fmt)
    writer = t.table(spark, sf_dir, name).write.option("compression", "gzip")
    if fmt == "csv":
        writer.csv(path, header=True)
    else:
        writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)


def csv_scan(spark, sf_dir):
    base = _fresh(spark, "source")
    _source_file(spark, sf_dir, "customer", "csv", base)
    path = sources.zone_path({"source": base}, "source", "customer", "csv")
    return sources.read_source(spark, path, "csv", t.table(spark, sf_dir, "customer").schema)


def json_scan(spark, sf_dir):
    base = _fresh(spark, "source")
    _source_file(spark, sf_dir, "events", "json", base)
    path = sources.zone_path({"source": base}, "source", "events", "json")
    return sources.read_source(spark, path, "json", t.table(spark, sf_dir, "events").schema)


def raw_ingest(spark, sf_dir):
    zones = {"source": _fresh(spark, "source"), "raw": _fresh(spark, "raw")}
    formats = {"customer": "csv", "events": "json"}
    for name, fmt in formats.items():
        _source_file(spark, sf_dir, name, fmt, zones["source"])
    manifest = [(n, f, t.table(spark, sf_dir, n).schema) for n, f in formats.items()]
    customer, events = (
        sources.scan(spark, path, RUN_DATE, "partition_column")
        for path in plans.ingest(spark, zones, manifest, RUN_DATE)
    )

    def labelled(df: DataFrame, dataset: str, key: str, label: str) -> DataFrame:
        return df.select(
            F.lit(dataset).alias("dataset"),
            F.col(key).alias("id"),
            F.col(label).alias("label"),
            "partition_column",
        )

    return labelled(customer, "customer", "c_custkey", "c_name").union(
        labelled(events, "events", "event_id", "event_type")
    )


def parquet_unpartitioned(spark, sf_dir):
    path = _fresh(spark, "part")
    sources.write_flat(t.table(spark, sf_dir, "part"), path, files=sources.AUTO)
    return spark.read.parquet(path)


def _raw_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.status(spark, sf_dir).withColumnsRenamed(
        {"status_created_at": "created_at", "status_value": "value"}
    )


def raw_scan_renamed(spark, sf_dir):
    path = _fresh(spark, "status")
    sources.write_day(_raw_status(spark, sf_dir), path, RUN_DATE)
    return sources.raw_status(spark, path, RUN_DATE)


def partition_scan_day(spark, sf_dir):
    path = _fresh(spark, "events")
    sources.write_by_day(t.table(spark, sf_dir, "events"), path, F.to_date("ts"))
    day = sources.latest_day_before(spark, path, dt.date(2024, 1, 16))
    return sources.scan(spark, path, day)


def evolved_scan(spark, sf_dir):
    """Raw orders of two days by their declared schema: the first day's files lack a column, which has a default,
    and hold another in a narrower type."""
    path, registry = _fresh(spark, "orders"), sources.Registry(spark, _fresh(spark, "schemas"))
    orders = t.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), "o_orderpriority"
    )
    late = F.col("o_orderkey") % 2 == 1
    first = orders.filter(~late).drop("o_orderpriority")
    second = orders.filter(late).withColumn("o_custkey", F.col("o_custkey").cast("long"))
    for df, day, defaults in (
        (first, RUN_DATE - dt.timedelta(days=1), {}),
        (second, RUN_DATE, {"o_orderpriority": "'NONE'"}),
    ):
        registry.declare("orders", df.schema, defaults)
        sources.write_day(df, path, day)
    return sources.scan(spark, path, day_column="partition_column", schema=registry.schema("orders"))


def quarantined_records(spark, sf_dir):
    """Customers delivered as CSV in which every seventh balance is no number: rows that fit, and rows set aside."""
    zones = {name: _fresh(spark, name) for name in ("source", "raw", "quarantine")}
    customer = t.table(spark, sf_dir, "customer")
    broken = F.when(F.col("c_custkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    path = sources.zone_path(zones, "source", "customer", "csv")
    customer.withColumn("c_acctbal", broken).write.option("compression", "gzip").csv(path, header=True)
    plans.ingest(spark, zones, [("customer", "csv", customer.schema)], RUN_DATE, quarantine=True)
    good = sources.scan(spark, sources.zone_path(zones, "raw", "customer"), RUN_DATE, "partition_column")
    bad = sources.scan(spark, sources.zone_path(zones, "quarantine", "customer"), RUN_DATE, "partition_column")
    key = F.split_part("_record", F.lit(","), F.lit(1)).cast("long")
    return good.select("c_custkey", "c_name", "c_acctbal", F.lit(False).alias("set_aside")).unionByName(
        bad.select(key.alias("c_custkey"), F.lit(True).alias("set_aside")), allowMissingColumns=True
    )


def _gated(spark, sf_dir, second: DataFrame) -> DataFrame:
    """Every order as yesterday's snapshot, then `second` as today's; the table as it reads after."""
    path = _fresh(spark, "order")
    sources.write_gated(t.orders(spark, sf_dir), path, RUN_DATE - dt.timedelta(days=1))
    gate = sources.write_gated(second, path, RUN_DATE)
    return (
        sources.scan(spark, path)
        .groupBy("partition")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumns(
            {
                "dataset": F.lit(gate.dataset),
                "actual": F.lit(gate.actual).cast("bigint"),
                "previous": F.lit(gate.previous).cast("bigint"),
                "written": F.lit(gate.written),
            }
        )
    )


def gated_write_pass(spark, sf_dir):
    orders = t.orders(spark, sf_dir)
    return _gated(spark, sf_dir, plans.orders_with_merchants(orders, t.merchants(spark, sf_dir)))


def gated_write_refused(spark, sf_dir):
    return _gated(spark, sf_dir, latest_order_per_customer(spark, sf_dir))


def file_inventory(spark, sf_dir):
    """The days for which a tree of events holds files."""
    path = _fresh(spark, "events")
    sources.write_by_day(t.table(spark, sf_dir, "events"), path, F.to_date("ts"))
    files = sources.file_inventory(spark, path, pattern="*.parquet", prefix="partition=", suffix=".parquet")
    day = F.to_date(F.split_part("dataset", F.lit("="), F.lit(2)))
    return files.filter("length > 0").select(day.alias("day")).distinct()


def view_sql_filter(spark, sf_dir):
    t.status(spark, sf_dir).createOrReplaceTempView("status")
    return spark.sql("SELECT * FROM status WHERE status_value = 'PLACED'")


def equality_filter(spark, sf_dir):
    return t.status(spark, sf_dir).filter(F.col("status_value") == "CANCELLED")


# Reports


def table_profile(spark, sf_dir):
    keys = ["o_orderkey", "o_custkey"]
    return ops.profile(t.table(spark, sf_dir, "orders"), keys, ["o_orderpriority"], dense=keys)


def preview_rows(spark, sf_dir):
    return ops.preview(t.table(spark, sf_dir, "events"), 20, ["event_id"])


def duplicate_keys(spark, sf_dir):
    days = t.status(spark, sf_dir).withColumn("day", F.to_date("status_created_at"))
    return ops.duplicate_keys(days, ["order_id", "day"])


def distinct_rows(spark, sf_dir):
    return ops.distinct_rows(t.status(spark, sf_dir), ["order_id", "status_value"])


def id_lengths(spark, sf_dir):
    return ops.text_lengths(t.table(spark, sf_dir, "part"), "p_name")


# Joins and newest rows


def orders_consumers(spark, sf_dir):
    return plans.orders_with_consumers(t.orders(spark, sf_dir), t.consumers(spark, sf_dir))


def orders_merchants(spark, sf_dir):
    return plans.orders_with_merchants(t.orders(spark, sf_dir), t.merchants(spark, sf_dir))


def latest_order_per_customer(spark, sf_dir):
    return ops.latest(t.orders(spark, sf_dir), "customer_id", "order_created_at", ["order_id"])


def latest_status_per_order(spark, sf_dir):
    return ops.latest(t.status(spark, sf_dir), "order_id", "status_created_at", ["status_value"])


def limited_orders(spark, sf_dir):
    return ops.preview(orders_merchants(spark, sf_dir), 1000, ["order_created_at", "order_id"])


# Anonymization and run day


def anonymized_customers(spark, sf_dir):
    names = t.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("c_mktsegment")
    )
    return hash_columns(names, ["c_name", "c_mktsegment"], SALT)


def masked_numbers(spark, sf_dir):
    return t.consumers(spark, sf_dir).select(
        "customer_id",
        mask_linear("customer_phone_number").alias("masked_number"),
        mask_linear("c_mktsegment").alias("masked_text"),
    )


def run_day(spark, sf_dir):
    return t.table(spark, sf_dir, "events").select("event_id", local_day("ts").alias("day"))


# Item documents


def _carts_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written once: queries that read them more than once find them made, and run without Python."""
    path = _fresh(spark, "cart")
    carts = t.carts(spark, sf_dir)
    sources.write_flat(carts, path)
    return spark.read.schema(carts.schema).parquet(path)


def items_parsed(spark, sf_dir):
    return _item_rows(ops.parse_items(_carts_kept(spark, sf_dir)))


def items_inferred(spark, sf_dir):
    docs = _carts_kept(spark, sf_dir)
    return _item_rows(ops.parse_items(docs, ops.infer_items_schema(docs)))


def items_inferred_by_day(spark, sf_dir):
    """Documents of three days, parsed by the schema that each day's run adds its own day's texts to."""
    path, days = _fresh(spark, "order"), [RUN_DATE - dt.timedelta(days=2 - k) for k in range(3)]
    day = F.date_add(F.lit(days[0]), F.pmod("order_id", F.lit(3)).cast("int"))
    sources.write_by_day(t.carts(spark, sf_dir), path, day, row_group_bytes=DOCUMENT_ROW_GROUP)
    inferred = sources.InferredSchemas(spark, _fresh(spark, "items"))
    for upto in range(3):
        schema = inferred.schema(days[: upto + 1], lambda d: sources.scan(spark, path, d))
    return _item_rows(ops.parse_items(sources.scan(spark, path), schema))


def _item_rows(parsed: DataFrame) -> DataFrame:
    return ops.explode_items(parsed).select(
        "order_id",
        F.col("item.name").alias("name"),
        F.col("item.quantity").cast("double").alias("quantity"),
        F.col("item.externalId").alias("external_id"),
        F.col("item.customerNote").alias("customer_note"),
        F.col("item.totalValue.value").alias("total_value"),
        F.size("item.garnishItems").alias("garnishes"),
    )


def malformed_documents(spark, sf_dir):
    """Orders whose document does not parse: every third one here has lost its last bracket."""
    cut = F.expr("substring(items, 1, length(items) - 1)")
    carts = _carts_kept(spark, sf_dir)
    return ops.malformed_items(
        carts.withColumn("items", F.when(F.col("order_id") % 3 == 0, cut).otherwise(F.col("items")))
    ).select("order_id")


def item_detail(spark, sf_dir):
    detail = ops.item_detail(_carts_kept(spark, sf_dir))
    return detail.withColumn("garnish_items", F.size("garnish_items"))


def garnish_detail(spark, sf_dir):
    return ops.garnish_detail(_carts_kept(spark, sf_dir))


def order_items(spark, sf_dir):
    return ops.order_items(_carts_kept(spark, sf_dir))


def order_items_joined(spark, sf_dir):
    return ops.order_items(_carts_kept(spark, sf_dir), always_join=True)


def order_items_per_item(spark, sf_dir):
    return ops.order_items(_carts_kept(spark, sf_dir), per_item=True)


def items_wide(spark, sf_dir):
    def listed(c):
        # Nulls are left out, so it does not matter where they sort; `array_sort` would compare by a lambda.
        return F.array_join(F.sort_array(c), ",")

    wide = ops.items_wide(_carts_kept(spark, sf_dir))
    return wide.select(
        "order_id",
        F.size("name").alias("items"),
        listed("name").alias("names"),
        listed("external_id").alias("external_ids"),
        listed("total_value").alias("total_values"),
        listed("total_value_currency").alias("currencies"),
        F.size("garnish_items_name").alias("garnish_lists"),
        listed(F.flatten("garnish_items_name")).alias("garnish_names"),
        listed(F.flatten("garnish_items_external_id")).alias("garnish_ids"),
        listed(F.flatten("garnish_items_total_value")).alias("garnish_values"),
        F.aggregate(F.flatten("garnish_items_quantity"), F.lit(0.0), lambda a, b: a + b).alias(
            "garnish_quantity"
        ),
    )


# Composite jobs


def trusted_order(spark, sf_dir):
    consumers = t.consumers(spark, sf_dir)
    return plans.trusted_order(
        t.orders(spark, sf_dir),
        consumers.withColumn("customer_phone_number", mask_linear("customer_phone_number")),
        t.merchants(spark, sf_dir),
        t.status(spark, sf_dir),
        RUN_DATE,
        SALT,
    )


def order_statuses(spark, sf_dir):
    return ops.status_table(t.orders(spark, sf_dir), t.status(spark, sf_dir), gather=False)


def order_statuses_one_pass(spark, sf_dir):
    return ops.status_table(t.orders(spark, sf_dir), t.status(spark, sf_dir))


def order_statuses_latest(spark, sf_dir):
    return ops.latest_statuses(t.orders(spark, sf_dir), t.status(spark, sf_dir))


def order_status_funnel(spark, sf_dir):
    return ops.status_funnel(t.orders(spark, sf_dir), t.status(spark, sf_dir))


def trusted_order_incremental(spark, sf_dir):
    """Five raw days in which orders, statuses, consumers and merchants arrive in no order of time, each added to
    what the day before left; the last day's trusted orders."""
    zones = {"raw": _fresh(spark, "raw"), "trusted": _fresh(spark, "trusted")}
    days = [RUN_DATE - dt.timedelta(days=4 - k) for k in range(5)]

    def dealt(df: DataFrame, name: str, *columns: str) -> None:
        nth = F.pmod(F.xxhash64(*columns), F.lit(len(days))).cast("int")
        day = F.date_add(F.lit(days[0]), nth)
        sources.write_by_day(df, sources.zone_path(zones, "raw", name), day, "partition_column")
        plans.registry(spark, zones).declare(name, df.schema)

    dealt(t.orders(spark, sf_dir), "order", "order_id")
    dealt(_raw_status(spark, sf_dir), "status", "order_id", "value", "created_at")
    dealt(t.consumers(spark, sf_dir), "consumer", "customer_id")
    dealt(t.merchants(spark, sf_dir), "restaurant", "id")
    for day in days:
        plans.refresh_orders(spark, zones, day, SALT, incremental=True)
    return sources.scan(spark, sources.zone_path(zones, "trusted", "order"), RUN_DATE)


def orders_status_colocated(spark, sf_dir):
    """Orders with their latest status, joined bucket by bucket from tables stored by order id."""
    database = f"q{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    plans.publish_colocated(
        t.orders(spark, sf_dir), t.status(spark, sf_dir), _fresh(spark, "by_id"), RUN_DATE, 8, database
    )
    return plans.orders_with_last_status(spark, RUN_DATE, database)


def trusted_lake(spark, sf_dir):
    """All jobs on a lake of their own: raw days, the three trusted tables, and what they hold."""
    zones = {"raw": _fresh(spark, "raw"), "trusted": _fresh(spark, "trusted")}
    for name, df in (
        ("order", t.orders_with_carts(spark, sf_dir)),
        ("status", _raw_status(spark, sf_dir)),
        ("consumer", t.consumers(spark, sf_dir)),
        ("restaurant", t.merchants(spark, sf_dir)),
    ):
        sources.write_day(df, sources.zone_path(zones, "raw", name), RUN_DATE)
    held = None
    for gate in plans.refresh_trusted(spark, zones, RUN_DATE, SALT):
        rows = sources.scan(spark, sources.zone_path(zones, "trusted", gate.dataset), RUN_DATE).agg(
            F.lit(gate.dataset).alias("dataset"),
            F.lit(gate.written).alias("written"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("order_id").alias("orders"),
        )
        held = rows if held is None else held.unionByName(rows)
    return held


QUERIES = {
    f.__name__: f
    for f in (
        csv_scan,
        json_scan,
        raw_ingest,
        parquet_unpartitioned,
        raw_scan_renamed,
        partition_scan_day,
        gated_write_pass,
        gated_write_refused,
        file_inventory,
        view_sql_filter,
        equality_filter,
        table_profile,
        preview_rows,
        duplicate_keys,
        distinct_rows,
        id_lengths,
        orders_consumers,
        orders_merchants,
        latest_order_per_customer,
        latest_status_per_order,
        limited_orders,
        anonymized_customers,
        masked_numbers,
        run_day,
        items_parsed,
        items_inferred,
        items_inferred_by_day,
        malformed_documents,
        item_detail,
        garnish_detail,
        order_items,
        order_items_joined,
        order_items_per_item,
        items_wide,
        trusted_order,
        order_statuses,
        order_statuses_one_pass,
        order_statuses_latest,
        order_status_funnel,
        trusted_lake,
        trusted_order_incremental,
        orders_status_colocated,
        evolved_scan,
        quarantined_records,
    )
}
