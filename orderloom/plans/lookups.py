"""Lookups over the stored gold table, as they are made by hand or from an application.

Equality on an id reaches the Parquet readers of the version log, which pass over files and row groups
whose limits or Bloom filters exclude it (`Store.compact_gold` lays them out for that). Only then are
versions resolved, and only those of the orders found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.operators.keyed import resolve_gold
from orderloom.plans import summary
from orderloom.sinks.tables import Store, partition_values


def orders_of_customer(store: Store, customer_id: str, since=None, until=None) -> DataFrame:
    """Gold rows of a customer, newest first.

    The first version of an order says whose it is, and later versions may name another customer or
    none. So the id finds candidates; all their versions are then taken from the candidates' time
    partitions, resolved, and held against the id again.
    """
    named = store.gold_versions(since, until).where(F.col("customer_id") == customer_id).select(
        *S.GOLD_KEY, "event_date")
    versions = store.gold_of(partition_values(named, "event_date")).join(
        named, [*S.GOLD_KEY, "event_date"], "left_semi")
    return summary.orders_for_customer(resolve_gold(versions.drop("event_date")), customer_id)


def order_history(store: Store, order_id: str, since=None, until=None) -> DataFrame:
    """Every stored version of an order's events, with the batch that wrote it, oldest first."""
    return store.gold_versions(since, until).where(F.col("order_id") == order_id).drop(
        "event_date").orderBy("event_timestamp", "batch_id")


def order_now(store: Store, order_id: str, since=None, until=None) -> DataFrame:
    """The gold rows of an order, one per order event."""
    return resolve_gold(store.gold_versions(since, until).where(
        F.col("order_id") == order_id).drop("event_date"))


def recent_orders(store: Store, since, until) -> DataFrame:
    """Orders with since <= time < until, newest first, from the folders of these days alone."""
    return summary.recent_orders(store.gold(since, until), since)


def sla_misses(store: Store, since, until) -> DataFrame:
    """Orders of that time that missed a limit, newest first. A miss is known after resolving only, as
    a later version may mend it."""
    return summary.sla_misses(store.gold(since, until))
