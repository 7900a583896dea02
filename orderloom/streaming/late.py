"""Late events by an exact rule.

Native watermarks drop late rows without a trace, and only some time after the watermark has passed.
Here an event is late when it is older than the newest event time of its topic seen before its batch,
less the allowed delay. Late events go to the dead letter table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.skew import left_join_unique
from orderloom.functions.times import plus_seconds
from orderloom.schemas import WATERMARK_SECONDS
from orderloom.sinks.tables import Store, read_table, write_batch

LATE = "LATE_EVENT"
# Microseconds since 1970 instead of a timestamp: nothing depends on the driver's own time zone.
_PROGRESS = "topic string, newest_micros bigint"


def is_late(event_time: Column, newest_before: Column, delay: int = WATERMARK_SECONDS) -> Column:
    return F.coalesce(event_time < plus_seconds(newest_before, -delay), F.lit(False))


def newest_before(store: Store, batch_id: int) -> dict[str, int]:
    """Newest event time per topic before this batch, in microseconds: one small row per topic.

    Every batch stores the running maximum, so the folder of the batch before is all that is read.
    If it is absent although there are batches before, progress was lost, and that is an error.
    """
    path = store.path("progress")
    before = read_table(store.spark, path, _PROGRESS, within=f"batch_id={batch_id - 1}")
    if before.isEmpty() and batch_id > 0:
        earlier = read_table(store.spark, path, _PROGRESS).where(F.col("batch_id") < batch_id)
        if not earlier.isEmpty():
            raise ValueError(f"progress of batch {batch_id - 1} is missing in {path}")
    rows = before.groupBy("topic").agg(F.max("newest_micros").alias("newest")).collect()
    return {r.topic: r.newest for r in rows if r.newest is not None}


def save_progress(store: Store, newest: dict[str, int], batch_id: int) -> None:
    """One row per topic, or an empty one; made from literals, so no Python worker is needed."""
    entries = [F.struct(F.lit(topic).alias("topic"), F.lit(micros).cast("bigint")
                        .alias("newest_micros")) for topic, micros in sorted(newest.items())]
    entries = entries or [F.struct(F.lit(None).cast("string").alias("topic"),
                                   F.lit(None).cast("bigint").alias("newest_micros"))]
    rows = store.spark.range(1, numPartitions=1).select(F.explode(F.array(*entries)).alias("e"))
    write_batch(rows.select("e.*"), store.path("progress"), batch_id)


def mark_late(events: DataFrame, topic: str = "topic", batch: str = "batch",
              event_time: str = "event_timestamp", delay: int = WATERMARK_SECONDS) -> DataFrame:
    """The same rule over stored events that carry their batch: adds `late`.

    Maxima per topic and batch are tiny, and the running maximum is taken over them, not over the
    events.
    """
    newest = events.groupBy(topic, batch).agg(F.max(event_time).alias("_newest"))
    earlier = (Window.partitionBy(topic).orderBy(batch)
               .rowsBetween(Window.unboundedPreceding, -1))
    bounds = newest.withColumn("_before", F.max("_newest").over(earlier)).drop("_newest")
    return (left_join_unique(events, bounds, [topic, batch])
            .withColumn("late", is_late(F.col(event_time), F.col("_before"), delay))
            .drop("_before"))
