import json

from helpers import messages, order_event

from orderloom import schemas as S
from orderloom.operators.payload import payload_fields, with_payload

PATHS = {"2.0": {"total_amount": "$.totals.amount", "currency": "$.totals.currency"}}


def fields(spark, *values, paths=None):
    rows = messages(spark, *[(S.ORDERS_TOPIC, v) for v in values])
    return payload_fields(with_payload(rows, S.ORDERS_TOPIC), S.ORDERS_TOPIC, paths)


def test_fields_by_schema_version_and_unknown_ones_kept(spark):
    old = order_event(items=[{"sku": "S1", "quantity": 2}], coupon={"code": "X", "pct": 5}, gift=None)
    new = order_event(schema_version="2.0", total_amount=..., currency=...,
                      totals={"amount": 7.25, "currency": "EUR", "tax": 1})
    mixed = order_event(schema_version="1.1", totals={"amount": 3})
    got = fields(spark, old, new, mixed, paths=PATHS).orderBy("source_offset").collect()
    assert [(r.schema_version, r.total_amount, r.currency) for r in got] == [
        ("1.0", 19.99, "USD"), ("2.0", 7.25, "EUR"), ("1.1", 19.99, "USD")]
    assert json.loads(got[0].unknown) == {"coupon": {"code": "X", "pct": 5}, "gift": None}
    assert got[0]["items"][0].sku == "S1" and got[0]["items"][0].unit_price is None
    assert got[1].unknown is None
    assert json.loads(got[2].unknown) == {"totals": {"amount": 3}}


def test_what_is_no_object_has_no_fields(spark):
    got = fields(spark, "not json", "", None, "[1,2]", "5", '{"order_id":"A","order_id":"B"}',
                 order_event(total_amount="much", customer_id=7)).orderBy("source_offset").collect()
    for r in got[:6]:
        assert r.order_id is None and r.unknown is None
    assert [r.payload is None for r in got] == [True, True, True, False, False, True, False]
    assert got[6].total_amount is None and got[6].customer_id == "7" and got[6].order_id == "O1"


def test_each_message_is_parsed_once(spark):
    rows = fields(spark, order_event(), paths=PATHS).where(
        "order_id = 'O1' AND total_amount > 1 AND currency = 'USD'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.lower().count("parse_json") + plan.lower().count("parsejson") == 1
