"""Small inputs for the tests."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from orderloom import schemas as S

AS_OF = "2024-01-15 12:00:00"
ORDERS = ("order_id string, event_type string, ts string, customer_id string, "
          "total_amount decimal(10,2), status string")
PAYMENTS = ("payment_id string, event_type string, ts string, order_id string, "
            "amount decimal(10,2), gateway string")
INVENTORY = "inventory_id string, event_type string, ts string, order_id string, sku string"


def _timed(spark, data, schema):
    return (spark.createDataFrame(data, schema)
            .withColumn("event_timestamp", F.col("ts").cast("timestamp")).drop("ts"))


def orders(spark, *data):
    from decimal import Decimal
    full = [(i, kind, ts, "C1", Decimal("9.50"), "new") for i, kind, ts in data]
    return _timed(spark, full, ORDERS)


def payments(spark, *data):
    from decimal import Decimal
    full = [(p, kind, ts, o, Decimal("9.50"), "STRIPE") for p, kind, ts, o in data]
    return _timed(spark, full, PAYMENTS)


def inventory(spark, *data):
    return _timed(spark, [(i, kind, ts, o, "SKU-1") for i, kind, ts, o in data], INVENTORY)


def messages(spark, *values, first_offset=0):
    """Messages from (topic, dict, text or None) pairs."""
    data = []
    for n, (topic, value) in enumerate(values):
        text = json.dumps(value) if isinstance(value, (dict, list)) else value
        data.append((None, None if text is None else bytearray(text.encode()), topic, 0,
                     first_offset + n, None, 0))
    return spark.createDataFrame(data, S.ENVELOPE)


def order_event(**changes):
    event = {"order_id": "O1", "event_type": "ORDER_CREATED",
             "event_timestamp": "2024-01-15T10:00:00.000000+00:00", "schema_version": "1.0",
             "customer_id": "C1", "total_amount": 19.99, "currency": "USD", "status": "new"}
    return {k: v for k, v in {**event, **changes}.items() if v is not ...}


def payment_event(**changes):
    event = {"payment_id": "P1", "event_type": "PAYMENT_CONFIRMED",
             "event_timestamp": "2024-01-15T10:00:20.000000+00:00", "order_id": "O1",
             "amount": 19.99, "gateway": "STRIPE", "status": "done"}
    return {k: v for k, v in {**event, **changes}.items() if v is not ...}


def inventory_event(**changes):
    event = {"inventory_id": "I1", "event_type": "INVENTORY_RESERVED",
             "occurred_at": "2024-01-15T10:00:30.000000+00:00", "sku": "S1", "quantity_delta": -2,
             "warehouse_id": "W1", "order_id": "O1"}
    return {k: v for k, v in {**event, **changes}.items() if v is not ...}
