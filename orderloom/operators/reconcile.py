"""The per-order match of orders, payments and inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.functions.skew import left_join_unique
from orderloom.functions.times import latency_seconds, moment, plus_seconds, within_seconds

SLICE_SECONDS = 10 * S.JOIN_WINDOW_SECONDS
UNMATCHED = "NO_PAYMENT_OR_INVENTORY_WITHIN_WINDOW"

_KEYED = "order_id IS NOT NULL AND event_timestamp IS NOT NULL"


def created_orders(orders: DataFrame) -> DataFrame:
    return orders.where(_KEYED).where(F.col("event_type") == "ORDER_CREATED")


def confirmed_payments(payments: DataFrame) -> DataFrame:
    return payments.where(_KEYED).where(F.col("payment_id").isNotNull()
                                       & (F.col("event_type") == "PAYMENT_CONFIRMED"))


def terminal_payments(payments: DataFrame) -> DataFrame:
    """Payments in a final state: confirmed, failed, disputed or refunded."""
    return payments.where(_KEYED).where(F.col("payment_id").isNotNull()
                                       & F.col("event_type").isin(*S.TERMINAL_PAYMENT_TYPES))


def reservations(inventory: DataFrame) -> DataFrame:
    return inventory.where(_KEYED).where(F.col("inventory_id").isNotNull()
                                        & (F.col("event_type") == "INVENTORY_RESERVED"))


def order_legs(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", "event_timestamp", F.struct(
        F.col("customer_id"), F.col("total_amount"), F.col("status").alias("order_status"),
    ).alias("placed"))


def payment_legs(payments: DataFrame) -> DataFrame:
    return payments.select("order_id", "event_timestamp", F.struct(
        F.col("payment_id"), F.col("gateway").alias("payment_gateway"),
        F.col("amount").alias("payment_amount")).alias("paid"))


def inventory_legs(inventory: DataFrame) -> DataFrame:
    return inventory.select("order_id", "event_timestamp", F.struct(
        F.col("inventory_id"), F.col("sku")).alias("stocked"))


def timeline(orders: DataFrame, payments: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row per order id and instant, with the smallest order, payment and stock leg there.

    The minimum is combined before the shuffle, so any number of copies at one instant cost a task
    one row, and the instant in the key spreads an order id that holds a large share of the events.
    """
    legs = (order_legs(orders).unionByName(payment_legs(payments), allowMissingColumns=True)
            .unionByName(inventory_legs(inventory), allowMissingColumns=True))
    return legs.groupBy("order_id", "event_timestamp").agg(
        F.min("placed").alias("placed"), F.min("paid").alias("paid"),
        F.min("stocked").alias("stocked"))


def reconcile(orders: DataFrame, payments: DataFrame, inventory: DataFrame, *,
              join_window: int = S.JOIN_WINDOW_SECONDS, sla: int = S.SLA_SECONDS,
              inventory_sla: int | None = None, slice_seconds: int = SLICE_SECONDS,
              as_of=None) -> DataFrame:
    """Each created order with its earliest confirmed payment and reservation in the window.

    Both matches are forward as-of lookups: the earliest event from the order's time up to
    `join_window` seconds later, ends included, smallest id first among equal times. They are read
    off one sorted pass over the timeline, so candidates are never paired with each other.
    Work is split by order id and time slice. A payment or reservation less than a window after a
    slice's start is also placed in the slice before, where an order may still be waiting for it: of
    slices ten windows wide that is one in ten, of slices as wide as the window it would be all.
    """
    width = max(slice_seconds, join_window)
    second = F.unix_seconds("event_timestamp")
    own = F.floor(second / F.lit(width))
    earliest = F.when(F.col("paid").isNotNull() | F.col("stocked").isNotNull(),
                      F.floor((second - F.lit(join_window)) / F.lit(width))).otherwise(own)
    # Shuffled here, as narrow as the rows are: a leg takes up its time only after that.
    sliced = (
        timeline(created_orders(orders), confirmed_payments(payments), reservations(inventory))
        .select("order_id", "event_timestamp", "placed", "paid", "stocked",
                F.explode(F.sequence(earliest, own)).alias("slice"))
        .withColumn("placed", F.when(F.col("slice") == own, F.col("placed")))
        .repartition("order_id", "slice")
        .select("order_id", "event_timestamp", "slice", "placed", *[
            F.when(F.col(leg).isNotNull(), F.struct(
                F.col("event_timestamp").alias("at"), f"{leg}.*")).alias(leg)
            for leg in ("paid", "stocked")]))
    # Latest first: the last leg seen so far is the nearest one at or after the row's own time.
    onward = (Window.partitionBy("order_id", "slice").orderBy(F.col("event_timestamp").desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    nearest = sliced.select(
        "order_id", "event_timestamp", "placed",
        F.last("paid", ignorenulls=True).over(onward).alias("paid"),
        F.last("stocked", ignorenulls=True).over(onward).alias("stocked"),
    ).where(F.col("placed").isNotNull())
    limit = plus_seconds(F.col("event_timestamp"), join_window)
    matched = nearest.select(
        "order_id", "event_timestamp", "placed.*",
        F.when(F.col("paid.at") <= limit, F.col("paid")).alias("paid"),
        F.when(F.col("stocked.at") <= limit, F.col("stocked")).alias("stocked"))
    return gold_rows(matched, sla=sla, inventory_sla=inventory_sla, as_of=as_of)


def gold_rows(matched: DataFrame, *extra: str, sla: int = S.SLA_SECONDS,
              inventory_sla: int | None = None, as_of=None) -> DataFrame:
    """The 17 gold columns from an order row with its `paid` and `stocked` legs, then `extra`.

    `inventory_sla` is the limit of reservations, that of payments unless given. Limits are compared
    with the exact time between; only the latency shown is rounded.
    """
    ordered_at = F.col("event_timestamp")
    allowed = {"paid": sla, "stocked": sla if inventory_sla is None else inventory_sla}

    def latency(leg: str) -> Column:
        return latency_seconds(ordered_at, F.col(f"{leg}.at"))

    def met(leg: str) -> Column:
        return within_seconds(ordered_at, F.col(f"{leg}.at"), allowed[leg])

    return matched.select(
        "order_id", "event_timestamp", "customer_id", "total_amount", "order_status",
        F.col("paid.payment_id").alias("payment_id"),
        F.col("paid.at").alias("payment_confirmed_at"),
        F.col("paid.payment_gateway").alias("payment_gateway"),
        F.col("paid.payment_amount").alias("payment_amount"),
        met("paid").alias("payment_sla_met"),
        latency("paid").alias("payment_latency_seconds"),
        F.col("stocked.inventory_id").alias("inventory_id"),
        F.col("stocked.at").alias("inventory_reserved_at"),
        F.col("stocked.sku").alias("sku"),
        met("stocked").alias("inventory_sla_met"),
        latency("stocked").alias("inventory_latency_seconds"),
        moment(as_of).alias("reconciled_at"), *extra)


def reconcile_unbounded(orders: DataFrame, payments: DataFrame, inventory: DataFrame, *,
                        sla: int = S.SLA_SECONDS, inventory_sla: int | None = None,
                        as_of=None) -> DataFrame:
    """Every order event, also one without id or time, with the earliest final payment and reservation of its id, at any time.

    There is no time bound, so a payment may precede its order and have a negative latency. Instead
    of one row per combination of order, payment and reservation, each order event comes once, with
    the number of payments and reservations it has; `unbounded_legs` lists them one by one.
    """
    def timed(legs: DataFrame, leg: str) -> DataFrame:
        return legs.select("order_id", F.struct(
            F.col("event_timestamp").alias("at"), f"{leg}.*").alias(leg))

    legs = (timed(payment_legs(terminal_payments(payments)), "paid")
            .unionByName(timed(inventory_legs(reservations(inventory)), "stocked"),
                         allowMissingColumns=True)
            .groupBy("order_id").agg(
                F.min("paid").alias("paid"), F.min("stocked").alias("stocked"),
                F.count("paid").alias("payment_matches"),
                F.count("stocked").alias("inventory_matches")))
    joined = left_join_unique(order_legs(orders), legs, ["order_id"])
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("payment_matches", "inventory_matches")]
    return gold_rows(
        joined.select("order_id", "event_timestamp", "placed.*", "paid", "stocked", *counts),
        "payment_matches", "inventory_matches", sla=sla, inventory_sla=inventory_sla, as_of=as_of)


def unbounded_legs(orders: DataFrame, payments: DataFrame, inventory: DataFrame, *,
                   sla: int = S.SLA_SECONDS) -> DataFrame:
    """Every final payment and every reservation with the first event of its order, if any.

    As many rows come out as legs go in, whatever the number of legs per order; each is compared with
    the first event of its order.
    """
    anchors = orders.where(_KEYED).groupBy("order_id").agg(
        F.min("event_timestamp").alias("ordered_at"))
    paid = terminal_payments(payments).select(
        "order_id", F.lit("payment").alias("leg"), F.col("payment_id").alias("leg_id"),
        "event_type", F.col("event_timestamp").alias("leg_at"))
    stocked = reservations(inventory).select(
        "order_id", F.lit("inventory").alias("leg"), F.col("inventory_id").alias("leg_id"),
        "event_type", F.col("event_timestamp").alias("leg_at"))
    joined = left_join_unique(paid.unionByName(stocked), anchors, ["order_id"])
    latency = latency_seconds(F.col("ordered_at"), F.col("leg_at"))
    return joined.select(
        "order_id", "leg", "leg_id", "event_type", "leg_at", "ordered_at",
        latency.alias("latency_seconds"),
        within_seconds(F.col("ordered_at"), F.col("leg_at"), sla).alias("sla_met"))


def is_unmatched() -> Column:
    return F.col("payment_id").isNull() & F.col("inventory_id").isNull()


def matched_rows(gold: DataFrame) -> DataFrame:
    """Rows with a payment or a reservation."""
    return gold.where(~is_unmatched())


def unmatched_rows(gold: DataFrame, older_than=None) -> DataFrame:
    """Rows with neither, tagged for the dead letter table.

    In a stream an order is a candidate only once nothing can still arrive for it: pass the time
    before which orders count as settled as `older_than`.
    """
    rows = gold.where(is_unmatched())
    if older_than is not None:
        rows = rows.where(F.col("event_timestamp") < moment(older_than))
    return (rows.withColumn("failure_reason", F.lit(UNMATCHED))
            .withColumn("source_topic", F.lit("reconciler")))
