import pytest
from helpers import AS_OF, inventory_event, messages, order_event, payment_event

from orderloom import schemas as S
from orderloom.functions.times import parse_iso
from orderloom.operators.deadletter import (as_messages, dead_letters_from_events,
                                            dead_letters_from_messages)
from orderloom.operators.gateway import flatten
from orderloom.operators.normalise import normalise
from orderloom.operators.parse import failed_rows, parse, parsed_rows
from orderloom.operators.validate import invalid_rows, storage_faults, valid_rows, validate
from pyspark.sql import functions as F

FAR = "2024-01-15T12:05:01+00:00"
LIMIT = "2024-01-15T12:05:00+00:00"


def code(spark, topic, event, **kw):
    parsed = parsed_rows(parse(messages(spark, (topic, event)), topic))
    return validate(parsed, topic, AS_OF, **kw).first().failure_code


@pytest.mark.parametrize("changes,expected", [
    ({}, None),
    ({"order_id": "   "}, "MISSING_ORDER_ID"),
    ({"order_id": "\t"}, "MISSING_ORDER_ID"),
    ({"event_type": None}, "MISSING_EVENT_TYPE"),
    ({"event_type": ""}, "MISSING_EVENT_TYPE"),
    ({"event_timestamp": ...}, "MISSING_TIMESTAMP"),
    ({"event_type": "ORDER_LOST"}, "UNKNOWN_EVENT_TYPE"),
    ({"total_amount": 0}, "INVALID_AMOUNT"),
    ({"total_amount": -1}, "INVALID_AMOUNT"),
    ({"total_amount": None}, None),
    ({"event_timestamp": "soon"}, "UNPARSEABLE_TIMESTAMP"),
    ({"event_timestamp": "2024-02-30T00:00:00Z"}, "UNPARSEABLE_TIMESTAMP"),
    ({"event_timestamp": LIMIT}, None),
    ({"event_timestamp": FAR}, "FUTURE_TIMESTAMP"),
    ({"event_timestamp": "2024-01-15T12:05:01"}, "FUTURE_TIMESTAMP"),
    ({"schema_version": "99.0"}, "UNKNOWN_SCHEMA_VERSION"),
    ({"schema_version": ""}, None),
    ({"event_type": None, "schema_version": "99.0"}, "MISSING_EVENT_TYPE"),
    ({"currency": "EURO"}, "VALUE_TOO_LONG"),
    ({"order_id": "x" * 51}, "VALUE_TOO_LONG"),
    ({"total_amount": 1e9}, "VALUE_OUT_OF_RANGE"),
])
def test_order_rules(spark, changes, expected):
    assert code(spark, S.ORDERS_TOPIC, order_event(**changes)) == expected


@pytest.mark.parametrize("changes,expected", [
    ({}, None),
    ({"inventory_id": " "}, "MISSING_INVENTORY_ID"),
    ({"event_type": None}, "MISSING_EVENT_TYPE"),
    ({"occurred_at": None}, "MISSING_OCCURRED_AT"),
    ({"sku": " \t"}, "MISSING_SKU"),
    ({"event_type": "INVENTORY_LOST"}, "UNKNOWN_EVENT_TYPE"),
    ({"quantity_delta": None}, "MISSING_QUANTITY_DELTA"),
    ({"quantity_delta": 0}, "ZERO_QUANTITY_DELTA"),
    ({"quantity_delta": 10000}, None),
    ({"quantity_delta": 10001}, "QUANTITY_DELTA_OUT_OF_BOUNDS"),
    ({"quantity_delta": -2147483648}, "QUANTITY_DELTA_OUT_OF_BOUNDS"),
    ({"occurred_at": "soon"}, "UNPARSEABLE_TIMESTAMP"),
    ({"occurred_at": FAR}, "FUTURE_TIMESTAMP"),
    ({"warehouse_id": "nowhere"}, None),
])
def test_inventory_rules(spark, changes, expected):
    assert code(spark, S.INVENTORY_TOPIC, inventory_event(**changes)) == expected


@pytest.mark.parametrize("changes,expected", [
    ({}, None),
    ({"payment_id": " "}, "MISSING_PAYMENT_ID"),
    ({"event_type": None}, "MISSING_EVENT_TYPE"),
    ({"event_timestamp": None}, "MISSING_TIMESTAMP"),
    ({"event_type": "PAYMENT_LOST"}, "UNKNOWN_EVENT_TYPE"),
    ({"amount": None}, "INVALID_AMOUNT_FOR_CONFIRMED"),
    ({"amount": 0}, "INVALID_AMOUNT_FOR_CONFIRMED"),
    ({"amount": 50000}, None),
    ({"amount": 50000.01}, "AMOUNT_EXCEEDS_LIMIT"),
    ({"event_type": "PAYMENT_REFUNDED", "amount": -1}, "NEGATIVE_AMOUNT"),
    ({"event_type": "PAYMENT_FAILED", "amount": 0}, None),
    ({"gateway": "CASHBOX"}, "UNKNOWN_GATEWAY"),
    ({"gateway": ""}, None),
    ({"order_id": None}, None),
    ({"event_timestamp": "soon"}, "UNPARSEABLE_TIMESTAMP"),
    ({"event_timestamp": FAR}, "FUTURE_TIMESTAMP"),
])
def test_payment_rules(spark, changes, expected):
    assert code(spark, S.PAYMENTS_TOPIC, payment_event(**changes)) == expected


def test_storage_limits_can_be_left_out(spark):
    assert code(spark, S.ORDERS_TOPIC, order_event(currency="EURO"), storage_limits=False) is None


def test_valid_and_invalid_rows_split_all(spark):
    batch = messages(spark, (S.ORDERS_TOPIC, order_event()),
                     (S.ORDERS_TOPIC, order_event(total_amount=-1)))
    checked = validate(parsed_rows(parse(batch, S.ORDERS_TOPIC)), S.ORDERS_TOPIC, AS_OF)
    assert valid_rows(checked).count() == 1
    bad = invalid_rows(checked, S.ORDERS_TOPIC).first()
    assert (bad.failure_reason, bad.source_topic) == ("INVALID_AMOUNT:-1.0", S.ORDERS_TOPIC)


def test_parse_keeps_the_text_of_failures(spark):
    texts = ["not json", "", None, "[1,2]", '"x"', order_event(order_id=...),
             order_event(total_amount="many"), order_event()]
    parsed = parse(messages(spark, *[(S.ORDERS_TOPIC, t) for t in texts]), S.ORDERS_TOPIC)
    bad = {r.source_offset: r.value for r in failed_rows(parsed).collect()}
    assert sorted(bad) == [0, 1, 2, 3, 4, 5, 6]
    assert bad[0] == "not json" and bad[2] is None and '"many"' in bad[6]
    assert [r.source_offset for r in parsed_rows(parsed).collect()] == [7]


def test_lenient_parse_makes_wrong_types_null(spark):
    batch = messages(spark, (S.ORDERS_TOPIC, order_event(total_amount="many")))
    row = parsed_rows(parse(batch, S.ORDERS_TOPIC, strict_types=False)).first()
    assert row.order_id == "O1" and row.total_amount is None


def test_extra_fields_vanish(spark):
    row = parse(messages(spark, (S.PAYMENTS_TOPIC, payment_event(gateway_fee=1.5))),
                S.PAYMENTS_TOPIC)
    assert "gateway_fee" not in row.columns and row.first().parse_error is None


@pytest.mark.parametrize("text,expected", [
    ("2024-01-15T10:00:00.123456+00:00", "2024-01-15 10:00:00.123456"),
    ("2024-01-15T10:00:00+00:00", "2024-01-15 10:00:00"),
    ("2024-01-15T10:00:00Z", "2024-01-15 10:00:00"),
    ("2024-01-15T12:00:00+02:00", "2024-01-15 10:00:00"),
    ("2024-01-15T10:00:00", "2024-01-15 10:00:00"),
    ("2024-01-15", "2024-01-15 00:00:00"),
    ("2024-13-15T10:00:00Z", None), ("now", None), ("", None), (None, None)])
def test_iso_texts(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").select(
        parse_iso(F.col("t")).cast("string").alias("t"))
    assert df.first().t == expected


def test_inventory_time_is_renamed(spark):
    batch = messages(spark, (S.INVENTORY_TOPIC, inventory_event()))
    out = normalise(parsed_rows(parse(batch, S.INVENTORY_TOPIC)), S.INVENTORY_TOPIC)
    assert "occurred_at" not in out.columns
    assert dict(out.dtypes)["event_timestamp"] == "timestamp"


def test_dead_letter_messages(spark, rows):
    batch = messages(spark, *[(S.DEAD_LETTER_TOPIC, v) for v in (
        {"failure_reason": "R", "source_topic": "t"}, {"failure_reason": None}, [1], "oops", None,
        {"failure_reason": "x" * 300})])
    out = rows(dead_letters_from_messages(batch, AS_OF), "source_topic", "failure_reason",
               "raw_payload")
    found = {r["raw_payload"][:12]: (r["source_topic"], r["failure_reason"]) for r in out}
    here = S.DEAD_LETTER_TOPIC
    assert found['{"failure_re'] is not None and len(out) == 6
    assert {(r["source_topic"], r["failure_reason"]) for r in out} == {
        ("t", "R"), (here, "UNKNOWN"), (here, "INVALID_JSON"), (here, "x" * 200)}


def test_dead_letters_from_any_shape(spark):
    plain = spark.range(1)
    row = dead_letters_from_events(plain, AS_OF).first()
    assert (row.source_topic, row.failure_reason, row.raw_payload) == (
        "reconciler", "UNKNOWN", '{"id":0}')


def test_dead_letters_go_through_their_topic(spark):
    rejected = messages(spark, (S.ORDERS_TOPIC, "junk")).select(
        "value", F.lit("R").alias("failure_reason"), F.lit("t").alias("source_topic"))
    sent = as_messages(dead_letters_from_events(rejected, AS_OF))
    back = dead_letters_from_messages(sent, AS_OF).first()
    assert (back.failure_reason, back.source_topic) == ("R", "t") and "junk" in back.raw_payload


def gateway_event(kind="payment_intent.succeeded", created=1705312800, **obj):
    body = {"id": "pi_1", "amount": 1999, "currency": "usd", "status": "ok",
            "metadata": {"order_id": "O1"}, "charges": {"data": [{"id": "ch_1"}, {"id": "ch_2"}]}}
    return {"stripe_event_id": "evt_1", "event_type": kind, "raw_payload": {
        "id": "evt_1", "type": kind, "created": created, "data": {"object": {**body, **obj}}}}


def test_gateway_event_is_flattened(spark):
    row = flatten(messages(spark, (S.GATEWAY_TOPIC, gateway_event(
        last_payment_error={"code": "declined"})))).first().asDict()
    assert str(row.pop("amount")) == "19.99"
    assert row == {
        "payment_id": "pi_1", "event_type": "PAYMENT_CONFIRMED",
        "event_timestamp": "2024-01-15T10:00:00+00:00", "schema_version": "1.0", "order_id": "O1",
        "currency": "USD", "gateway": "STRIPE", "status": "ok", "gateway_event_id": "evt_1",
        "gateway_transaction_id": "ch_1", "failure_reason": "declined",
        "raw_stripe_event": "payment_intent.succeeded"}


def test_gateway_gaps(spark):
    batch = messages(
        spark, (S.GATEWAY_TOPIC, gateway_event(metadata={}, charges={"data": []}, currency=None,
                                               amount=None, created=None)),
        (S.GATEWAY_TOPIC, gateway_event(kind="customer.created")), (S.GATEWAY_TOPIC, "junk"))
    first, again = flatten(batch).collect(), flatten(batch).collect()
    assert len(first) == 1 and first == again
    row = first[0]
    assert row.order_id.startswith("ORD-") and len(row.order_id) == 36
    assert (row.amount, row.currency, row.event_timestamp, row.gateway_transaction_id) == (
        None, "", None, None)


def test_storage_faults_are_those_of_all_rules(spark):
    """A business fault comes first, also where a text is too long; null texts are not too long."""
    long = "x" * 51
    orders = [order_event(order_id="ORD-1"), order_event(order_id=long),
              order_event(order_id=long, event_timestamp="soon"),
              order_event(order_id=long, event_timestamp=FAR),
              order_event(order_id="ORD-2", currency="EURO", total_amount=1e9),
              order_event(order_id="ORD-3", currency=None, status=None, total_amount=1e9),
              order_event(order_id="ORD-4", currency=None, customer_id=None, total_amount=None),
              order_event(order_id="ORD-5", total_amount=-1e9)]
    stock = [inventory_event(warehouse_id=long), inventory_event(warehouse_id=None),
             inventory_event(warehouse_id=long, quantity_delta=0)]
    paid = [payment_event(status=long), payment_event(status=long, amount=50001), payment_event()]
    found = []
    for topic, events in ((S.ORDERS_TOPIC, orders), (S.INVENTORY_TOPIC, stock),
                          (S.PAYMENTS_TOPIC, paid)):
        rows = parsed_rows(parse(messages(spark, *[(topic, e) for e in events]), topic))
        fields = ("source_topic", "source_offset", "failure_code", "failure_detail")
        some = sorted(storage_faults(rows, topic, AS_OF).select(*fields).collect())
        full = validate(rows, topic, AS_OF).where(
            "failure_code IN ('VALUE_TOO_LONG', 'VALUE_OUT_OF_RANGE')").select(*fields)
        assert some == sorted(full.collect())
        found += [r.failure_code for r in some]
    assert sorted(found) == ["VALUE_OUT_OF_RANGE"] + ["VALUE_TOO_LONG"] * 4
