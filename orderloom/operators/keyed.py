"""Conflict rules of keyed tables: first row wins, last row wins, and the mixed rule of gold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.functions.times import moment


def first_wins(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by `order`.

    Spark limits each key to one row per task before the shuffle, so a key with very many copies
    reaches its task as a handful of rows.
    """
    ranked = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def last_wins(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by `order`."""
    return first_wins(rows, key, [F.col(c).desc() for c in order])


def only_new(rows: DataFrame, stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet."""
    return rows.join(stored.select(*key), list(key), "left_anti")


def resolve_versions(versions: DataFrame, key: Sequence[str], first_write: Sequence[str],
                     version: str) -> DataFrame:
    """One row per key: `first_write` columns of its first version, all others of its last.

    Both ends are picked by a minimum and a maximum over structs, combined before the shuffle.
    """
    rest = [c for c in versions.columns if c not in (*key, *first_write, version)]
    resolved = versions.groupBy(*key).agg(
        F.min(F.struct(version, *first_write)).alias("first"),
        F.max(F.struct(version, *rest)).alias("last"))
    picked = [
        F.col(c) if c in key else F.col(f"first.{c}" if c in first_write else f"last.{c}")
        for c in versions.columns if c != version]
    return resolved.select(*picked)


def resolve_gold(versions: DataFrame, version: str = "batch_id") -> DataFrame:
    return resolve_versions(versions, S.GOLD_KEY, S.GOLD_FIRST_WRITE, version)


_CARRIED = ("value", "source_topic", "source_offset", "broker_timestamp")


def with_full_key(events: DataFrame, topic: str) -> DataFrame:
    """Events that have every column of the raw table's key."""
    for name in S.TOPICS[topic].raw_key:
        events = events.where(F.col(name).isNotNull())
    return events


def event_columns(events: DataFrame) -> list[str]:
    """Columns of the event itself, without what it carries along from the broker."""
    return [c for c in events.columns if c not in _CARRIED]


def raw_columns(event: Mapping[str, Column], topic: str, as_of=None) -> list[Column]:
    """Columns of a raw table from those of an event.

    Zero amounts and quantities stay zero. The whole event is kept as JSON text.
    """
    typed = {"total_amount": "decimal(10,2)", "amount": "decimal(10,2)"}
    made = {"raw_payload": F.to_json(F.struct(*[c.alias(name) for name, c in event.items()])),
            "ingested_at": moment(as_of),
            **{name: event[name].try_cast(kind) for name, kind in typed.items() if name in event}}
    return [made.get(name, event.get(name, F.col(name))).alias(name)
            for name in S.RAW_COLUMNS[topic]]


def raw_rows(events: DataFrame, topic: str, as_of=None) -> DataFrame:
    """Rows of a raw table from normalised events; rows without a full key are left out."""
    carried = [c for c in ("source_offset",) if c in events.columns]
    event = {c: F.col(c) for c in event_columns(events)}
    return with_full_key(events, topic).select(*raw_columns(event, topic, as_of), *carried)
