"""The two jobs: source files to raw days, raw days to the three trusted tables."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructType

from daylake.operators.nested import order_items
from daylake.operators.statuses import latest_statuses, status_table
from daylake.plans import incremental as inc
from daylake.plans.trusted_order import trusted_order
from daylake.sources import commits, files, readers
from daylake.sources.inferred import InferredSchemas
from daylake.sources.registry import Registry
from daylake.sources.writers import GateResult, write_day, write_gated
from daylake.sources.zones import SOURCE, zone_path

log = logging.getLogger(__name__)

RAW, TRUSTED, QUARANTINE = "raw", "trusted", "quarantine"


class Ingested(NamedTuple):
    dataset: str
    path: str
    #: Why the dataset was not ingested; None if it was.
    error: str | None = None
    #: Records that did not fit and are in quarantine.
    set_aside: int = 0


class IngestFailed(RuntimeError):
    """Some datasets of a manifest were not ingested; the others were."""

    def __init__(self, results: list[Ingested]):
        self.results = results
        failed = [f"{r.dataset}: {r.error}" for r in results if r.error]
        super().__init__("; ".join(failed))


def registry(spark: SparkSession, zones: Mapping[str, str], zone: str = RAW) -> Registry:
    """The declared schemas of a zone's datasets."""
    return Registry(spark, f"{zones[zone].rstrip('/')}/_schemas")


def ingest(
    spark: SparkSession,
    zones: Mapping[str, str],
    manifest: Iterable[tuple[str, str] | tuple[str, str, StructType | None]],
    run_date: dt.date,
    side_by_side: int = 1,
    quarantine: bool = False,
    infer: bool = False,
) -> list[str]:
    """`ingest_each`, and an error that names what failed once all datasets had their turn."""
    results = ingest_each(spark, zones, manifest, run_date, side_by_side, quarantine, infer)
    if any(r.error for r in results):
        raise IngestFailed(results)
    return [r.path for r in results]


def ingest_each(
    spark: SparkSession,
    zones: Mapping[str, str],
    manifest: Iterable[tuple[str, str] | tuple[str, str, StructType | None]],
    run_date: dt.date,
    side_by_side: int = 4,
    quarantine: bool = False,
    infer: bool = False,
) -> list[Ingested]:
    """Copy each `(dataset, format[, schema])` from the source zone into its raw day, in the manifest's order.

    Up to `side_by_side` datasets run at once, each in a scheduler pool of its name, so that a small one need not
    wait for the tasks of a large one where the scheduler is fair. One that fails is reported and stops no other.

    What is read is declared in the zone's registry, so that later scans need no footers. JSON is read by the
    schema given or declared; only where there is neither, or with `infer=True`, an extra pass looks for one.
    With `quarantine=True` records that do not fit a given or declared schema go to the quarantine zone.
    """
    known = registry(spark, zones)

    def one(entry: tuple) -> Ingested:
        name, fmt, *schema = entry
        target, set_aside = zone_path(zones, RAW, name), 0
        try:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            source = zone_path(zones, SOURCE, name, fmt)
            log.info("ingest %s as %s", source, fmt)
            declared = schema[0] if schema else None
            if declared is None and fmt == "json" and not infer:
                declared = known.schema(name)
            if quarantine and declared is not None:
                known.declare(name, declared)
                bad = _ingest_split(spark, zones, name, fmt, declared, run_date)
                set_aside = commits.rows_of(spark, bad).count()
                if set_aside:
                    log.warning("%s: %d records set aside", name, set_aside)
            else:
                rows = readers.read_source(spark, source, fmt, declared, fmt == "json" and declared is None)
                known.declare(name, rows.schema)
                write_day(rows, target, run_date)
        except Exception as e:  # noqa: BLE001: whatever stops one dataset is reported, not raised
            log.warning("%s was not ingested: %s", name, e)
            return Ingested(name, target, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}")
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        return Ingested(name, target, set_aside=set_aside)

    entries = list(manifest)
    with ThreadPoolExecutor(max(1, min(side_by_side, len(entries)))) as pool:
        return list(pool.map(one, entries))


#: Column of a record's own text while it is read, and of quarantined rows.
RECORD = "_record"


def _ingest_split(
    spark: SparkSession, zones: Mapping[str, str], name: str, fmt: str, schema: StructType, run_date: dt.date
) -> commits.Staged:
    """One pass over a source file into two tables: rows that fit the schema, and the text of those that do not.

    Both days are written unseen below the raw zone, then renamed and promoted. Returns where the second is.
    """
    rows = readers.read_source(spark, zone_path(zones, SOURCE, name, fmt), fmt, schema, corrupt=RECORD)
    table, bad = zone_path(zones, RAW, name), zone_path(zones, QUARANTINE, name)
    written = f"{zones[RAW].rstrip('/')}/_ingest/{uuid.uuid4().hex}"
    try:
        rows.selectExpr("*", f"{RECORD} IS NULL AS _fits").write.partitionBy("_fits").parquet(written)
        record = StructType([f for f in rows.schema if f.name == RECORD])
        for fits, target, fields in (("true", table, schema), ("false", bad, record)):
            part = f"{written}/_fits={fits}"
            if commits.holds_files(spark, part):
                staged = commits.stage_folder(spark, part, target, run_date, fields, readers.RAW_DAY)
            else:
                staged = commits.stage(spark.createDataFrame([], fields), target, run_date, readers.RAW_DAY)
            commits.promote(spark, staged)
    finally:
        files.remove(spark, written)
    return staged


def raw_schema(spark: SparkSession, zones: Mapping[str, str], name: str) -> StructType | None:
    """The declared schema of a raw dataset. One that was written without is declared now, from all its footers.

    A table with commits carries its own, and needs none here.
    """
    path = zone_path(zones, RAW, name)
    if commits.newest(spark, path) is not None:
        return registry(spark, zones).schema(name)
    known = registry(spark, zones)
    schema = known.schema(name)
    if schema is None:
        found = readers.scan(spark, path, day_column=readers.RAW_DAY).schema
        known.declare(name, StructType([f for f in found if f.name != readers.RAW_DAY]))
        schema = known.schema(name)
    return schema


def _raw(spark: SparkSession, zones: Mapping[str, str], name: str, read, days) -> DataFrame:
    return read(spark, zone_path(zones, RAW, name), days, raw_schema(spark, zones, name))


READ_RAW = {
    "order": readers.raw_orders,
    "consumer": readers.raw_consumers,
    "restaurant": readers.raw_merchants,
    "status": readers.raw_status,
}


def refresh_orders(
    spark: SparkSession,
    zones: Mapping[str, str],
    run_date: dt.date,
    salt: str,
    files: int | str | None = None,
    all_raw_days: bool = False,
    incremental: bool = False,
    **options,
) -> GateResult:
    """Trusted `order` from the raw day of the run, or from all raw days where each day brings only what is new.

    `incremental=True` gives what all raw days give, from the raw days since the last such run and the newest
    rows kept by it. Options go to `trusted_order`.
    """
    if all_raw_days and incremental:
        raise ValueError("all raw days are read anew, or what is new is added to what is kept")
    if incremental:
        order = {k: v for k, v in options.items() if k != "hashed"}
        state = inc.advance(
            spark,
            inc.state_path(zones, RAW),
            run_date,
            lambda days: inc.Newest(**{n: _raw(spark, zones, n, read, days) for n, read in READ_RAW.items()}),
            **order,
        )
        df = inc.trusted_from(state, run_date, salt, **options)
    else:
        days = None if all_raw_days else run_date
        raw = {name: _raw(spark, zones, name, read, days) for name, read in READ_RAW.items()}
        stored = {"stored": True} | options
        df = trusted_order(
            raw["order"], raw["consumer"], raw["restaurant"], raw["status"], run_date, salt, **stored
        )
    return write_gated(df.drop(readers.DAY), zone_path(zones, TRUSTED, "order"), run_date, files)


def refresh_order_items(
    spark: SparkSession,
    zones: Mapping[str, str],
    run_date: dt.date,
    day: dt.date | None = None,
    per_item: bool = False,
    files: int | str | None = None,
) -> GateResult:
    """Trusted `order_items` from every trusted day, or from one."""
    orders = readers.scan(spark, zone_path(zones, TRUSTED, "order"), day)
    df = order_items(orders, per_item)
    return write_gated(df, zone_path(zones, TRUSTED, "order_items"), run_date, files)


def items_schema(
    spark: SparkSession, zones: Mapping[str, str], run_date: dt.date, anew: Iterable[dt.date] = ()
) -> DataType:
    """The schema of the item documents of all trusted orders up to `run_date`. Only days that no earlier call has
    read, and those named in `anew`, are read."""
    path = zone_path(zones, TRUSTED, "order")
    commit = commits.newest(spark, path)
    days = commit.days if commit else commits.plain_days_with_files(spark, path)
    kept = InferredSchemas(spark, f"{zones[TRUSTED].rstrip('/')}/_schemas/order.items")
    return kept.schema([d for d in days if d <= run_date], lambda d: readers.scan(spark, path, d), anew=anew)


def refresh_order_statuses(
    spark: SparkSession,
    zones: Mapping[str, str],
    run_date: dt.date,
    day: dt.date | None = None,
    latest_only: bool = False,
    files: int | str | None = None,
    raw_day: dt.date | None = None,
) -> GateResult:
    """Trusted `order_statuses` from every trusted day, or from one, and the status rows of all
    raw days, or of one."""
    orders = readers.scan(spark, zone_path(zones, TRUSTED, "order"), day)
    status = _raw(spark, zones, "status", readers.raw_status, raw_day)
    build = latest_statuses if latest_only else status_table
    return write_gated(
        build(orders, status), zone_path(zones, TRUSTED, "order_statuses"), run_date, files
    )


def refresh_trusted(
    spark: SparkSession, zones: Mapping[str, str], run_date: dt.date, salt: str, incremental: bool = False
) -> list[GateResult]:
    """All three tables in order. A refused table keeps its old days, which the next ones read."""
    return [
        refresh_orders(spark, zones, run_date, salt, incremental=incremental),
        refresh_order_items(spark, zones, run_date),
        refresh_order_statuses(spark, zones, run_date),
    ]
