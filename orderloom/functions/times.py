"""Time expressions. All of them stay in generated JVM code."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO 8601 date, optional time with up to six fraction digits, optional zone.
ISO_TEXT = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"


EPOCH = datetime(1970, 1, 1)


def parse_iso(text: Column) -> Column:
    """ISO text to timestamp, null when it is not one. A text without zone is UTC."""
    return F.when(text.rlike(ISO_TEXT), text.try_cast("timestamp"))


def utc(value: str | datetime) -> datetime:
    """A time given by the caller in UTC, without a zone; one that names no zone is in UTC already."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    return value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value


def moment(value: str | datetime | Column | None) -> Column:
    """A point in time given by the caller; the clock when none is given.

    A datetime handed to Spark as it is would be read in the driver's own zone, so it goes as a number.
    """
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.timestamp_micros(F.lit((utc(value) - EPOCH) // timedelta(microseconds=1)))


def plus_seconds(ts: Column, seconds: int) -> Column:
    return ts + F.make_dt_interval(secs=F.lit(seconds))


def latency_seconds(start: Column, end: Column) -> Column:
    """Seconds between two times, two decimals, halves away from zero."""
    micros = F.timestamp_diff("MICROSECOND", start, end).cast("decimal(20,0)")
    return F.round(micros / F.lit(1000000).cast("decimal(7,0)"), 2).cast("decimal(18,2)")


def within_seconds(start: Column, end: Column, limit: int) -> Column:
    """Whether `end` is at most so many seconds after `start`, exact; false if either is missing."""
    return F.coalesce(F.timestamp_diff("MICROSECOND", start, end) <= F.lit(limit * 1_000_000),
                      F.lit(False))


def within_last_day(ts: Column, as_of: Column) -> Column:
    return (ts >= plus_seconds(as_of, -86400)) & (ts <= as_of)


def on_previous_day(ts: Column, as_of: Column) -> Column:
    today = F.date_trunc("day", as_of)
    return (ts >= plus_seconds(today, -86400)) & (ts < today)
