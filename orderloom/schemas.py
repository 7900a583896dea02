"""Event schemas, the topic registry, and the columns and keys of the stored tables.

Schemas are DDL strings: `from_json` and the readers take them as they are, on the driver and in
streams, without a type inference pass over the data.
"""

from __future__ import annotations

from dataclasses import dataclass

ORDERS_TOPIC = "order-events"
INVENTORY_TOPIC = "inventory-events"
PAYMENTS_TOPIC = "payment-events"
GATEWAY_TOPIC = "stripe-raw-events"
DEAD_LETTER_TOPIC = "dead-letter-events"

# What every message source yields.
ENVELOPE = ("key binary, value binary, topic string, partition int, offset bigint, "
            "timestamp timestamp, timestampType int")

CORRUPT = "_corrupt_record"

# Field names and types of the event contract.
ORDER_EVENT = (
    "order_id string, event_type string, event_timestamp string, schema_version string, "
    "customer_id string, total_amount double, currency string, status string, "
    "items array<struct<sku:string,quantity:int,unit_price:double,category:string>>, "
    "shipping_address struct<country:string,postal_code:string>, "
    "metadata struct<source:string,user_agent:string,session_id:string>"
)
INVENTORY_EVENT = (
    "inventory_id string, event_type string, occurred_at string, schema_version string, sku string, "
    "quantity_delta int, warehouse_id string, current_stock_level int, order_id string, "
    "metadata struct<operator_id:string,reason:string>"
)
PAYMENT_EVENT = (
    "payment_id string, event_type string, event_timestamp string, schema_version string, "
    "order_id string, amount double, currency string, gateway string, status string, "
    "gateway_event_id string, gateway_transaction_id string, failure_reason string, "
    "raw_stripe_event string"
)
GATEWAY_EVENT = (
    "stripe_event_id string, event_type string, received_at string, api_version string, "
    "raw_payload struct<id:string,type:string,created:bigint,data:struct<object:struct<"
    "id:string,amount:bigint,currency:string,status:string,metadata:map<string,string>,"
    "charges:struct<data:array<struct<id:string>>>,last_payment_error:struct<code:string>>>>"
)
DEAD_LETTER_EVENT = "failure_reason string, source_topic string"


@dataclass(frozen=True)
class Topic:
    """What the pipeline needs to know about one event topic."""

    name: str
    schema: str
    id_field: str
    time_field: str
    raw_table: str
    raw_key: tuple[str, ...]


TOPICS: dict[str, Topic] = {
    ORDERS_TOPIC: Topic(
        ORDERS_TOPIC, ORDER_EVENT, "order_id", "event_timestamp", "raw_order_events",
        ("order_id", "event_type", "event_timestamp")),
    INVENTORY_TOPIC: Topic(
        INVENTORY_TOPIC, INVENTORY_EVENT, "inventory_id", "occurred_at", "raw_inventory_events",
        ("inventory_id", "event_type", "event_timestamp")),
    PAYMENTS_TOPIC: Topic(
        PAYMENTS_TOPIC, PAYMENT_EVENT, "payment_id", "event_timestamp", "raw_payment_events",
        ("payment_id", "event_type", "event_timestamp")),
}

# Stored tables (fixed values: the columns of the raw, dead letter, gold and metrics tables).
# `event_date` and `failed_date` are partition columns in place of time indexes.
RAW_ORDERS = (
    "order_id string, event_type string, event_timestamp timestamp, customer_id string, "
    "total_amount decimal(10,2), currency string, status string, raw_payload string, "
    "ingested_at timestamp"
)
RAW_INVENTORY = (
    "inventory_id string, event_type string, event_timestamp timestamp, order_id string, sku string, "
    "quantity_delta int, warehouse_id string, raw_payload string, ingested_at timestamp"
)
RAW_PAYMENTS = (
    "payment_id string, event_type string, event_timestamp timestamp, order_id string, "
    "amount decimal(10,2), gateway string, status string, raw_payload string, ingested_at timestamp"
)
RAW_TABLES = {
    ORDERS_TOPIC: RAW_ORDERS,
    INVENTORY_TOPIC: RAW_INVENTORY,
    PAYMENTS_TOPIC: RAW_PAYMENTS,
}
RAW_COLUMNS = {topic: tuple(c.split()[0] for c in ddl.split(", ")) for topic, ddl in
               RAW_TABLES.items()}
DEAD_LETTERS = (
    "source_topic string, raw_payload string, failure_reason string, failed_at timestamp"
)
GOLD = (
    "order_id string, event_timestamp timestamp, customer_id string, total_amount decimal(10,2), "
    "order_status string, payment_id string, payment_confirmed_at timestamp, "
    "payment_gateway string, payment_amount decimal(10,2), payment_sla_met boolean, "
    "payment_latency_seconds decimal(10,2), inventory_id string, inventory_reserved_at timestamp, "
    "sku string, inventory_sla_met boolean, inventory_latency_seconds decimal(10,2), "
    "reconciled_at timestamp"
)
GOLD_KEY = ("order_id", "event_timestamp")
# On conflict these keep their first value; every other gold column takes the last one.
GOLD_FIRST_WRITE = ("customer_id", "total_amount", "order_status")
PIPELINE_METRICS = (
    "batch_id bigint, batch_timestamp timestamp, input_rows bigint, dlq_events bigint, "
    "reconciliation_failures bigint, reconciliation_failure_rate decimal(6,4), "
    "reconciled_rows bigint, sla_violations bigint, processing_duration_ms bigint"
)
RAW_PROFILES = "table_name string, column_name string, n bigint, ingested_at timestamp"
DEAD_LETTER_COUNTS = (
    "failed_at timestamp, source_topic string, failure_reason string, n bigint"
)
GOLD_HOURS = (
    "summary_date date, hour int, total_orders bigint, payment_sla_met bigint, "
    "inventory_sla_met bigint"
)
STREAM_PROGRESS = (
    "query_name string, run_id string, reported_at timestamp, input_rows bigint, batch_ms bigint, "
    "watermark timestamp, state_rows bigint, state_bytes bigint, late_rows bigint, observed string"
)
GOLD_CLOCKS = "reconciled_at timestamp, orders bigint, paid bigint"
CHECK_RESULTS = (
    "check_name string, check_date date, status string, expected_value double, "
    "actual_value double, details string"
)

# Accepted event types, gateways and schema versions.
ORDER_TYPES = ("ORDER_CREATED", "ORDER_CONFIRMED", "ORDER_UPDATED", "ORDER_CANCELLED",
               "ORDER_SHIPPED", "ORDER_DELIVERED")
INVENTORY_TYPES = ("INVENTORY_RESERVED", "INVENTORY_RELEASED", "INVENTORY_ADJUSTED",
                   "INVENTORY_RESTOCKED")
PAYMENT_TYPES = ("PAYMENT_INITIATED", "PAYMENT_CONFIRMED", "PAYMENT_FAILED", "PAYMENT_CANCELLED",
                 "PAYMENT_DISPUTED", "PAYMENT_REFUNDED")
TERMINAL_PAYMENT_TYPES = ("PAYMENT_CONFIRMED", "PAYMENT_FAILED", "PAYMENT_DISPUTED",
                          "PAYMENT_REFUNDED")
GATEWAYS = ("STRIPE", "PAYPAL", "ADYEN", "SQUARE")
SCHEMA_VERSIONS = ("1.0", "1.1", "2.0")

# Seconds.
FUTURE_SKEW_SECONDS = 300
SLA_SECONDS = 60
JOIN_WINDOW_SECONDS = 60
WATERMARK_SECONDS = 90
