"""Dead letter rows: from rejected events, and from messages of the dead letter topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.times import moment
from orderloom.schemas import CORRUPT, DEAD_LETTER_EVENT, DEAD_LETTER_TOPIC

# Fixed values.
REASON_LENGTH = 200
UNKNOWN = "UNKNOWN"
INVALID_JSON = "INVALID_JSON"
DEFAULT_SOURCE = "reconciler"


def _reason(reason: Column) -> Column:
    """The reason that a message brought along; the topic's consumer cuts it."""
    return F.substring(F.coalesce(reason, F.lit(UNKNOWN)), 1, REASON_LENGTH)


def dead_letters_from_events(rejected: DataFrame, as_of=None) -> DataFrame:
    """Rows of the dead letter table from rejected events of any shape.

    The payload is the message text where the row still has it as `value`, else the row as JSON.
    """
    columns = rejected.columns
    payload = F.to_json(F.struct("*"))
    if "value" in columns:
        payload = F.coalesce(F.col("value").cast("string"), payload)
    source = F.col("source_topic") if "source_topic" in columns else F.lit(None).cast("string")
    reason = F.col("failure_reason") if "failure_reason" in columns else F.lit(None).cast("string")
    return rejected.select(
        F.coalesce(source, F.lit(DEFAULT_SOURCE)).alias("source_topic"),
        payload.alias("raw_payload"), F.coalesce(reason, F.lit(UNKNOWN)).alias("failure_reason"),
        moment(as_of).alias("failed_at"))


def dead_letters_from_messages(messages: DataFrame, as_of=None) -> DataFrame:
    """Rows of the dead letter table from messages of the dead letter topic.

    Reason and topic come from the JSON object. What is no JSON object, an empty message included,
    is kept as `INVALID_JSON`; the text itself is never lost.
    """
    text = F.coalesce(F.col("value").cast("string"), F.lit(""))
    parsed = messages.select(
        text.alias("raw_payload"), "topic",
        F.from_json(text, f"{DEAD_LETTER_EVENT}, {CORRUPT} string",
                    {"columnNameOfCorruptRecord": CORRUPT}).alias("d"))
    broken = F.col("d").isNull() | F.col(f"d.{CORRUPT}").isNotNull()
    return parsed.select(
        F.when(broken, F.col("topic")).otherwise(F.coalesce("d.source_topic", "topic"))
        .alias("source_topic"),
        "raw_payload",
        F.when(broken, F.lit(INVALID_JSON)).otherwise(_reason(F.col("d.failure_reason")))
        .alias("failure_reason"),
        moment(as_of).alias("failed_at"))


def as_messages(dead_letters: DataFrame) -> DataFrame:
    """Rows of the dead letter table as messages for the dead letter topic."""
    body = F.to_json(F.struct("failure_reason", "source_topic", "raw_payload"))
    return dead_letters.select(
        F.lit(None).cast("binary").alias("key"), body.cast("binary").alias("value"),
        F.lit(DEAD_LETTER_TOPIC).alias("topic"))
