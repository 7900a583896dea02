"""Replay of an hourly archive through the micro-batch job, in bounded batches that can be restarted.

The hours of the range are cut into batches once, and the cut is stored before the first batch runs.
A batch that ended is noted. A run that starts after a stop reads both and goes on with the first
batch that is not noted, with the same hours and so the same rows as in the stopped run; what that
batch had written is replaced, as with any retry of the job.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.functions.times import EPOCH, utc
from orderloom.sinks.tables import Store, read_table, write_batch
from orderloom.sources.archive import replay, rows_per_hour
from orderloom.streaming.job import process_batch

KEPT = ("value string, source_topic string, source_offset bigint, broker_timestamp timestamp, "
        "event_timestamp timestamp")
PLAN = "n bigint, start_micros bigint, end_micros bigint, archived_rows bigint"
HOUR = timedelta(hours=1)


def archived_messages(spark: SparkSession, path: str, start, end) -> DataFrame:
    """The messages behind archived events with start <= event time < end, all topics.

    The archive keeps the whole text of a message, its offset and broker time, each topic in a folder of
    its own; it does not keep key and partition, which the job does not use.
    """
    events = reduce(DataFrame.unionByName, [
        replay(spark, f"{path}/{topic}", KEPT, start, end).select(
            "value", F.lit(topic).alias("source_topic"), "source_offset", "broker_timestamp")
        for topic in S.TOPICS])  # a known topic: who asks for one opens the files of one
    return events.select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.col("source_topic").alias("topic"), F.lit(0).alias("partition"),
        F.col("source_offset").alias("offset"), F.col("broker_timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"))


def cut_hours(hours: Iterable[tuple[datetime, int]], start: datetime, end: datetime,
              max_rows: int) -> list[tuple[datetime, datetime, int]]:
    """Runs of whole hours in ascending order with at most `max_rows` rows each, as (start, end, rows).

    An hour with more rows is a batch by itself: batches are then as large as the stream's own were.
    Hours without rows are in no batch, and the first and last hour end at the range's limits.
    """
    runs: list[list] = []
    for hour, n in sorted(hours):
        if runs and runs[-1][2] + n <= max_rows:
            runs[-1][1:] = [hour + HOUR, runs[-1][2] + n]
        else:
            runs.append([hour, hour + HOUR, n])
    return [(max(first, start), min(last, end), n) for first, last, n in runs]


def plan_backfill(store: Store, name: str, path: str, start, end, max_rows: int) -> DataFrame:
    """The stored cut of a backfill, made when there is none yet: one row per batch."""
    where = store.path(f"backfills/{name}/plan")
    stored = read_table(store.spark, where, PLAN).drop("batch_id")
    if stored.isEmpty():
        start, end = utc(start), utc(end)
        counts = reduce(DataFrame.unionByName, [
            rows_per_hour(store.spark, f"{path}/{topic}", start, end) for topic in S.TOPICS])
        hours = counts.groupBy(F.unix_micros("hour").alias("hour")).agg(F.sum("n").alias("n"))
        found = [(EPOCH + timedelta(microseconds=r.hour), r.n) for r in hours.collect()]
        rows = [(n, _micros(first), _micros(last), size) for n, (first, last, size) in enumerate(
            cut_hours(found, start, end, max_rows))]
        write_batch(store.spark.createDataFrame(rows, PLAN).coalesce(1), where, 0)
        stored = read_table(store.spark, where, PLAN).drop("batch_id")
    return stored


def backfill(store: Store, name: str, path: str, start, end, *, max_rows: int = 50_000_000,
             first_batch: int = 0, stop_after: int | None = None, **options) -> int:
    """Run archived events with start <= event time < end through the job; returns the batches left.

    `path` holds one archive per topic, as the job writes them. `name` names this backfill: a later
    call with the same name goes on with it, and its range, sizes and `first_batch` must stay as they
    were. `first_batch` is the job's id of the first batch, the one after the last in the store, where
    the first row of a key wins as always. `stop_after` ends the run after so many
    batches. Archived events had been accepted once, so none is judged late. `options` go to the job.
    """
    done = store.path(f"backfills/{name}/done")
    noted = {r.batch_id for r in read_table(store.spark, done, "n bigint").select(
        "batch_id").distinct().collect()}
    plan = plan_backfill(store, name, path, start, end, max_rows).orderBy("n").collect()
    todo = [step for step in plan if first_batch + step.n not in noted]
    now = todo if stop_after is None else todo[:stop_after]
    for step in now:
        low, high = (EPOCH + timedelta(microseconds=m) for m in (step.start_micros, step.end_micros))
        batch_id = first_batch + step.n
        process_batch(archived_messages(store.spark, path, low, high), batch_id, store,
                      **{"late_after": None, **options})
        write_batch(store.spark.range(step.n, step.n + 1, numPartitions=1).toDF("n"), done, batch_id)
    return len(todo) - len(now)


def _micros(time: datetime) -> int:
    return (time - EPOCH) // timedelta(microseconds=1)
