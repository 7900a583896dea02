"""Messages to event columns, and the split into parsed and failed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.schemas import CORRUPT, TOPICS, Topic

PARSE_FAILED = "SCHEMA_PARSE_FAILED"


def route(messages: DataFrame, topic: str) -> DataFrame:
    """The messages of one topic of a multi-topic source."""
    return messages.where(F.col("topic") == topic)


def parse(messages: DataFrame, topic: str, strict_types: bool = True) -> DataFrame:
    """One row per message: event columns, `value` as text, broker time, `parse_error`.

    A message fails when its id is absent. With `strict_types` it also fails when it is not JSON or
    a field has the wrong type; otherwise such a field is null and the row goes on. Broker fields
    come along as `source_topic`, `source_offset` and `broker_timestamp`.
    """
    spec: Topic = TOPICS[topic]
    text = F.col("value").cast("string")
    document = F.from_json(text, f"{spec.schema}, {CORRUPT} string",
                           {"columnNameOfCorruptRecord": CORRUPT})
    # As a generator of one row the document is read once. As a plain column it would be read again
    # for every field that a later filter names, since filters are moved below the projection.
    parsed = messages.select(
        F.inline(F.array(document)), text.alias("value"), F.col("topic").alias("source_topic"),
        F.col("offset").alias("source_offset"), F.col("timestamp").alias("broker_timestamp"))
    failed = F.col(spec.id_field).isNull()
    if strict_types:
        failed = failed | F.col(CORRUPT).isNotNull()
    return parsed.withColumn("parse_error", F.when(failed, F.lit(f"{PARSE_FAILED}:{topic}"))
                             ).drop(CORRUPT)


def parsed_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("parse_error").isNull()).drop("parse_error")


def failed_rows(parsed: DataFrame) -> DataFrame:
    """Failed messages with their reason and the original text."""
    return parsed.where(F.col("parse_error").isNotNull()).select(
        "value", "source_topic", "source_offset", "broker_timestamp",
        F.col("parse_error").alias("failure_reason"))
