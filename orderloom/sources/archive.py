"""Hourly Parquet archive of events, and its replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.times import moment
from orderloom.session import release
from orderloom.sinks.tables import read_table, write_batch

PARTITIONS = ("year", "month", "day", "hour")
FOLDERS = ", ".join(f"{c} int" for c in PARTITIONS)


def with_hour_columns(events: DataFrame, time_column: str = "event_timestamp") -> DataFrame:
    at = F.col(time_column)
    return events.withColumns({"year": F.year(at), "month": F.month(at),
                               "day": F.dayofmonth(at), "hour": F.hour(at)})


def archive(events: DataFrame, path: str, batch_id: int,
            time_column: str = "event_timestamp") -> None:
    """Add one batch. The batch has its own folder, so a retry replaces only what it wrote.

    Events without a time go to the default partition, which `replay` leaves out.
    """
    write_batch(with_hour_columns(events, time_column), path, batch_id, PARTITIONS)
    release(events.sparkSession)


def replay(spark: SparkSession, path: str, schema: str, start, end,
           time_column: str = "event_timestamp") -> DataFrame:
    """Archived events with start <= time < end.

    A filter on the time column alone would open every file. The hour of each folder is put
    together from its partition values, so folders outside the range are pruned without a look
    inside; the exact filter follows.
    """
    at = F.col(time_column)
    low, high = moment(start), moment(end)
    return _between(read_table(spark, path, schema, FOLDERS), low, high).where(
        (at >= low) & (at < high))


def rows_per_hour(spark: SparkSession, path: str, start, end) -> DataFrame:
    """Per archived hour that start <= time < end touches, the rows of its files. No column is read."""
    stored = _between(read_table(spark, path, "", FOLDERS), moment(start), moment(end))
    return stored.groupBy(folder_hour().alias("hour")).agg(F.count("*").alias("n"))


def folder_hour() -> Column:
    return F.make_timestamp("year", "month", "day", "hour", F.lit(0), F.lit(0).cast("decimal(16,6)"))


def _between(stored: DataFrame, low: Column, high: Column) -> DataFrame:
    return stored.where((folder_hour() >= F.date_trunc("hour", low)) & (folder_hour() < high))
