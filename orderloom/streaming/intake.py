"""What comes before a stream with state: late and bad messages taken out, not dropped.

A stream with a watermark drops what is behind it without a trace. `accept` judges each micro-batch of
messages first, by the job's rules and its exact late rule, sends what fails to the dead letters and
lands the rest, one folder per topic and batch, for the stream that keeps state. What has passed is
never behind that stream's watermark: it is no older than the newest event of its topic in earlier
batches less the delay, and a landed batch is seen by the next stream as a whole or not at all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom import schemas as S
from orderloom.operators.deadletter import dead_letters_from_events
from orderloom.operators.keyed import raw_rows
from orderloom.sinks.tables import COMPRESSION, Store, move_folder, remove_folder
from orderloom.streaming import job
from orderloom.streaming.late import newest_before, save_progress
from orderloom.streaming.streams import each_batch


def land(rows: DataFrame, path: str, topic: str, batch_id: int) -> None:
    """Write a folder aside and move it into place at once; a batch that has landed stays as it is."""
    aside = f"{path}/_landing/{topic}/batch_id={batch_id}"
    rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(aside)
    move_folder(rows.sparkSession, aside, f"{path}/{topic}/batch_id={batch_id}")


def accept_batch(messages: DataFrame, batch_id: int, store: Store, path: str, *, as_of=None,
                 strict_types: bool = True, delay: int = S.WATERMARK_SECONDS) -> None:
    """Dead letters and landed events of one batch; run again it gives the same."""
    clock = job.batch_clock(store, batch_id, as_of)
    newest = newest_before(store, batch_id)
    checked, scratch = job.checked_tables(store, {topic: job.check_events(
        messages, topic, newest.get(topic), clock, strict_types, delay, False) for topic in S.TOPICS})
    stray = job.stray_messages(messages)
    try:
        facts = job.batch_facts(store, checked, stray)
        rejected = reduce(DataFrame.unionByName, [
            e.where(F.col("failure_reason").isNotNull()).select(
                "value", "source_topic", "failure_reason") for e in checked.values()])

        def keep(topic: str) -> None:
            good = checked[topic].where(F.col("failure_reason").isNull())
            land(raw_rows(good, topic, clock).drop("source_offset"), path, topic, batch_id)

        job.side_by_side(
            store.spark, lambda: store.add_dead_letters(
                dead_letters_from_events(rejected.unionByName(stray), clock), batch_id),
            *[lambda topic=topic: keep(topic) for topic, f in facts.items()
              if topic in S.TOPICS and f.n > f.bad])
        for topic, f in facts.items():
            if f.newest is not None:
                newest[topic] = max(f.newest, newest.get(topic, f.newest))
        save_progress(store, newest, batch_id)
    finally:
        remove_folder(store.spark, scratch)


def accept(messages: DataFrame, store: Store, path: str, checkpoint: str, *,
           trigger: str | None = None, **options) -> StreamingQuery:
    """Judge a stream of messages of all topics. The store is this stream's own: batches are numbered
    by it. Without `trigger` everything available is processed and the query ends."""
    return each_batch(messages, lambda df, n: accept_batch(df, n, store, path, **options), checkpoint,
                      trigger=trigger)


def accepted(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """The stream of landed events of a topic."""
    return spark.readStream.schema(S.RAW_TABLES[topic]).option("basePath", f"{path}/{topic}").parquet(
        f"{path}/{topic}")
