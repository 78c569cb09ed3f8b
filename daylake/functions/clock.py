"""Run clock: one run date per job, taken from a fixed offset to UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC_OFFSET_HOURS = -3


def _local_now(offset_hours: int, now: dt.datetime | None) -> dt.datetime:
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.astimezone(dt.timezone(dt.timedelta(hours=offset_hours)))


def run_day(
    days_back: int = 0, offset_hours: int = UTC_OFFSET_HOURS, now: dt.datetime | None = None
) -> dt.date:
    """Local calendar day of the run. Every day of a job is counted back from the same clock,
    so "yesterday" can never be the same day as "today"."""
    return (_local_now(offset_hours, now) - dt.timedelta(days=days_back)).date()


def run_second(offset_hours: int = UTC_OFFSET_HOURS, now: dt.datetime | None = None) -> str:
    """Local time of the run to the second, for log lines."""
    return _local_now(offset_hours, now).strftime("%Y-%m-%d %H:%M:%S")


def local_day(ts: Column | str, offset_hours: int = UTC_OFFSET_HOURS) -> Column:
    """Local calendar day of a UTC timestamp column, as a partition key."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return (ts + F.expr(f"INTERVAL '{offset_hours}' HOUR")).cast("date")
