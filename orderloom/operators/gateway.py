"""Raw payment gateway events to flat payment events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.schemas import GATEWAY_EVENT, PAYMENTS_TOPIC

#: Digits of a stand-in order id: enough that two never meet, and within the stored 50 characters.
STAND_IN_DIGITS = 32

# Gateway event types and the payment event types they stand for.
EVENT_TYPES = {
    "payment_intent.succeeded": "PAYMENT_CONFIRMED",
    "payment_intent.payment_failed": "PAYMENT_FAILED",
    "payment_intent.created": "PAYMENT_INITIATED",
    "payment_intent.canceled": "PAYMENT_CANCELLED",
    "charge.dispute.created": "PAYMENT_DISPUTED",
    "charge.refunded": "PAYMENT_REFUNDED",
    "charge.succeeded": "PAYMENT_CONFIRMED",
    "charge.failed": "PAYMENT_FAILED",
}


def payment_type(kind: Column) -> Column:
    """The payment event type of a gateway type, null for a type that has none.

    Eight pairs, so they travel as a literal map inside the expression instead of a joined table.
    """
    pairs = F.create_map(*[F.lit(x) for pair in EVENT_TYPES.items() for x in pair])
    return F.try_element_at(pairs, kind)


def read_gateway(messages: DataFrame) -> DataFrame:
    text = F.col("value").cast("string")
    # A generator of one row: the filter on the type does not read the document a second time.
    return messages.select(F.inline(F.array(F.from_json(text, GATEWAY_EVENT))))


def flatten(messages: DataFrame) -> DataFrame:
    """Payment events, in the fields and types of the payment topic's JSON.

    Events of other types are left out here and stay in the raw topic. Cents become an amount with
    two decimals, unix seconds an ISO text. A payment without an order id gets one derived from its
    event id, so that a replay gives the same id again.
    """
    event = F.col("raw_payload")
    obj = event["data"]["object"]
    order_id = obj["metadata"]["order_id"]
    stand_in = F.concat(F.lit("ORD-"), F.upper(F.substring(F.sha2(event["id"], 256), 1, STAND_IN_DIGITS)))
    created = F.date_format(F.timestamp_seconds(event["created"]), "yyyy-MM-dd'T'HH:mm:ss")
    return (
        read_gateway(messages)
        .withColumn("mapped_type", payment_type(event["type"]))
        .where(F.col("mapped_type").isNotNull())
        .select(
            obj["id"].alias("payment_id"),
            F.col("mapped_type").alias("event_type"),
            F.concat(created, F.lit("+00:00")).alias("event_timestamp"),
            F.lit("1.0").alias("schema_version"),
            F.when(order_id != "", order_id).otherwise(stand_in).alias("order_id"),
            (obj["amount"].cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)"))
            .cast("decimal(20,2)").alias("amount"),
            F.upper(F.coalesce(obj["currency"], F.lit(""))).alias("currency"),
            F.lit("STRIPE").alias("gateway"),
            obj["status"].alias("status"),
            event["id"].alias("gateway_event_id"),
            F.get(obj["charges"]["data"]["id"], F.lit(0)).alias("gateway_transaction_id"),
            obj["last_payment_error"]["code"].alias("failure_reason"),
            event["type"].alias("raw_stripe_event")))


def as_payment_messages(payments: DataFrame) -> DataFrame:
    """Payment events as messages for the payment topic, keyed by order id."""
    return payments.select(
        F.col("order_id").cast("binary").alias("key"),
        F.to_json(F.struct("*")).cast("binary").alias("value"),
        F.lit(PAYMENTS_TOPIC).alias("topic"))
