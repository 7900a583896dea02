"""Messages as semi-structured payloads: fields by schema version, unknown fields kept.

`parse` reads a message by its topic's schema and drops what the schema does not name. Here the message
is parsed once into a VARIANT, from which fields are taken by path. A producer's newer schema version
may hold a field elsewhere, or hold more of them; nothing of it is lost.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schemas import TOPICS

Paths = Mapping[str, Mapping[str, str]]


def with_payload(messages: DataFrame, topic: str) -> DataFrame:
    """The broker fields and the message as `payload`, null when it is no JSON text.

    The text is parsed inside a generator of one row, so that later expressions take the parsed value
    instead of parsing again. A message that names a key twice has no payload.
    """
    text = F.col("value").cast("string")
    return messages.where(F.col("topic") == topic).select(
        F.inline(F.array(F.struct(F.try_parse_json(text).alias("payload")))), text.alias("value"),
        F.col("topic").alias("source_topic"), F.col("offset").alias("source_offset"),
        F.col("timestamp").alias("broker_timestamp"))


def field(name: str, kind: str, paths: Paths) -> Column:
    """A field of the payload at the path of its schema version, by default at the top under its name;
    null when it is missing or does not fit the type."""
    payload = F.col("payload")
    value = F.try_variant_get(payload, f"$.{name}", kind)
    for version, own in paths.items():
        if name in own:
            found = F.try_variant_get(payload, own[name], kind)
            value = F.when(_version() == version, found).otherwise(value)
    return value


def payload_fields(parsed: DataFrame, topic: str, paths: Paths | None = None) -> DataFrame:
    """The topic's fields from `payload`, and `unknown`: what else the message holds at the top, as JSON.

    `paths` names, per schema version, fields that lie elsewhere: `{"2.0": {"total_amount":
    "$.totals.amount"}}`. Top-level keys that such a path begins with count as known in that version.
    Without unknown keys, and for messages that are no object, `unknown` is null.
    """
    paths = paths or {}
    schema = T._parse_datatype_string(TOPICS[topic].schema)
    known = F.array(*[F.lit(f.name) for f in schema])
    for version, own in paths.items():
        tops = F.array(*[F.lit(p.removeprefix("$.").split(".")[0].split("[")[0]) for p in own.values()])
        known = F.when(_version() == version, F.array_union(known, tops)).otherwise(known)
    members = F.try_variant_get(F.col("payload"), "$", "map<string,variant>")
    rest = F.map_filter(members, lambda key, _: ~F.array_contains(known, key))
    return parsed.select(
        *[field(f.name, f.dataType.simpleString(), paths).alias(f.name) for f in schema],
        F.when(F.size(rest) > 0, F.to_json(rest)).alias("unknown"),
        *[c for c in parsed.columns])


def _version() -> Column:
    return F.coalesce(F.try_variant_get(F.col("payload"), "$.schema_version", "string"), F.lit(""))
