"""Message sources. All of them yield the envelope of `schemas.ENVELOPE`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from orderloom.schemas import ENVELOPE


def kafka_messages(spark: SparkSession, servers: str, topics: Sequence[str] | str,
                   starting: str = "latest", **options: str) -> DataFrame:
    """Stream of one topic or of several under one subscription.

    Event topics start at the latest offsets, the dead letter topic at the earliest. Needs the
    Kafka package of the Spark distribution on the cluster.
    """
    names = topics if isinstance(topics, str) else ",".join(topics)
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("subscribe", names)
            .option("startingOffsets", starting).option("failOnDataLoss", "false")
            .options(**options).load())


def file_messages(spark: SparkSession, path: str, topics: Sequence[str] | str | None = None,
                  max_files: int | None = None) -> DataFrame:
    """Stream of messages kept as Parquet files, optionally of some topics only."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(path)
    if topics is None:
        return stream
    return stream.where(stream.topic.isin([topics] if isinstance(topics, str) else list(topics)))


def stored_messages(spark: SparkSession, path: str) -> DataFrame:
    """The same files as a batch."""
    return spark.read.schema(ENVELOPE).parquet(path)
