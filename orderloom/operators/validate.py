"""Business rules as one ordered expression per topic. The first rule that fails names the fault."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.functions.texts import is_blank, is_missing
from orderloom.functions.times import moment, parse_iso, plus_seconds

# Limits of the business rules and of the stored columns.
MAX_PAYMENT = 50000
MAX_QUANTITY = 10000
# The event's time while it is judged.
AT = "_event_at"
TEXT_LIMITS = {
    S.ORDERS_TOPIC: {"order_id": 50, "event_type": 30, "customer_id": 50, "currency": 3,
                     "status": 20},
    S.INVENTORY_TOPIC: {"inventory_id": 50, "event_type": 30, "sku": 50, "warehouse_id": 50},
    S.PAYMENTS_TOPIC: {"payment_id": 50, "event_type": 30, "order_id": 50, "gateway": 20,
                       "status": 20},
}


@dataclass(frozen=True)
class Rule:
    """`broken` is true where the rule fails; `detail` is the offending value."""

    code: str
    broken: Column
    detail: Column | None = None


def _time_rules(field: str, as_of: Column) -> list[Rule]:
    text, at = F.col(field), F.col(AT)
    return [
        Rule("UNPARSEABLE_TIMESTAMP", at.isNull(), text),
        Rule("FUTURE_TIMESTAMP", at > plus_seconds(as_of, S.FUTURE_SKEW_SECONDS), text),
    ]


def _storage_rules(topic: str) -> list[Rule]:
    """What the stored column types cannot hold."""
    rules = [Rule("VALUE_TOO_LONG", F.length(name) > limit, F.lit(name))
             for name, limit in TEXT_LIMITS[topic].items()]
    amount = {S.ORDERS_TOPIC: "total_amount", S.PAYMENTS_TOPIC: "amount"}.get(topic)
    if amount:
        value = F.col(amount)
        rules.append(Rule("VALUE_OUT_OF_RANGE",
                          value.isNotNull() & value.try_cast("decimal(10,2)").isNull(),
                          F.lit(amount)))
    return rules


def order_rules(as_of: Column) -> list[Rule]:
    kind, amount, version = F.col("event_type"), F.col("total_amount"), F.col("schema_version")
    return [
        Rule("MISSING_ORDER_ID", is_blank(F.col("order_id"))),
        Rule("MISSING_EVENT_TYPE", is_missing(kind)),
        Rule("MISSING_TIMESTAMP", is_missing(F.col("event_timestamp"))),
        Rule("UNKNOWN_EVENT_TYPE", ~kind.isin(*S.ORDER_TYPES), kind),
        Rule("INVALID_AMOUNT", amount <= 0, amount.cast("string")),
        *_time_rules("event_timestamp", as_of),
        Rule("UNKNOWN_SCHEMA_VERSION",
             ~is_missing(version) & ~version.isin(*S.SCHEMA_VERSIONS), version),
    ]


def inventory_rules(as_of: Column) -> list[Rule]:
    kind, delta = F.col("event_type"), F.col("quantity_delta")
    return [
        Rule("MISSING_INVENTORY_ID", is_blank(F.col("inventory_id"))),
        Rule("MISSING_EVENT_TYPE", is_missing(kind)),
        Rule("MISSING_OCCURRED_AT", is_missing(F.col("occurred_at"))),
        Rule("MISSING_SKU", is_blank(F.col("sku"))),
        Rule("UNKNOWN_EVENT_TYPE", ~kind.isin(*S.INVENTORY_TYPES), kind),
        Rule("MISSING_QUANTITY_DELTA", delta.isNull()),
        Rule("ZERO_QUANTITY_DELTA", delta == 0),
        Rule("QUANTITY_DELTA_OUT_OF_BOUNDS", ~delta.between(-MAX_QUANTITY, MAX_QUANTITY),
             delta.cast("string")),
        *_time_rules("occurred_at", as_of),
    ]


def payment_rules(as_of: Column) -> list[Rule]:
    kind, amount, gateway = F.col("event_type"), F.col("amount"), F.col("gateway")
    shown = amount.cast("string")
    return [
        Rule("MISSING_PAYMENT_ID", is_blank(F.col("payment_id"))),
        Rule("MISSING_EVENT_TYPE", is_missing(kind)),
        Rule("MISSING_TIMESTAMP", is_missing(F.col("event_timestamp"))),
        Rule("UNKNOWN_EVENT_TYPE", ~kind.isin(*S.PAYMENT_TYPES), kind),
        Rule("INVALID_AMOUNT_FOR_CONFIRMED",
             (kind == "PAYMENT_CONFIRMED") & (amount.isNull() | (amount <= 0)), shown),
        Rule("AMOUNT_EXCEEDS_LIMIT", amount > MAX_PAYMENT, shown),
        Rule("NEGATIVE_AMOUNT", amount < 0, shown),
        Rule("UNKNOWN_GATEWAY", ~is_missing(gateway) & ~gateway.isin(*S.GATEWAYS), gateway),
        *_time_rules("event_timestamp", as_of),
    ]


_RULES = {
    S.ORDERS_TOPIC: order_rules,
    S.INVENTORY_TOPIC: inventory_rules,
    S.PAYMENTS_TOPIC: payment_rules,
}


def validate(events: DataFrame, topic: str, as_of=None, storage_limits: bool = True) -> DataFrame:
    """Add `failure_code` and `failure_detail`; both are null for a valid event.

    `as_of` stands for now in the future check. With `storage_limits` texts and amounts that do not
    fit the stored columns fail too, after all business rules.
    """
    return judge(events, topic, as_of, storage_limits).drop(AT)


def judge(events: DataFrame, topic: str, as_of=None, storage_limits: bool = True) -> DataFrame:
    """`validate` with the event's time, read once for all rules, in the column `AT`."""
    at = parse_iso(F.col(S.TOPICS[topic].time_field))
    # A generator of one row again: as a plain column the text would be read for each rule.
    timed = events.select("*", F.explode(F.array(at)).alias(AT))
    rules = _RULES[topic](moment(as_of))
    if storage_limits:
        rules = rules + _storage_rules(topic)
    first = F.coalesce(*[
        F.when(rule.broken, F.struct(
            F.lit(rule.code).alias("code"),
            (F.lit(None) if rule.detail is None else rule.detail).cast("string").alias("detail")))
        for rule in rules])
    # A generator of one row again, so that filters on the outcome do not repeat the rules.
    return timed.select("*", F.inline(F.array(first)).alias("failure_code", "failure_detail"))


def storage_faults(events: DataFrame, topic: str, as_of=None) -> DataFrame:
    """The rows of `validate` whose first fault is that the stored columns cannot hold them.

    Lengths and amounts are cheap to look at, so they are asked first: an event that breaks none of
    these rules cannot be in the result, and only the others have their time read and all rules tried.
    """
    rules = _storage_rules(topic)
    suspects = events.where(reduce(lambda a, b: a | b, [rule.broken for rule in rules]))
    return validate(suspects, topic, as_of).where(
        F.col("failure_code").isin(sorted({rule.code for rule in rules})))


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("failure_code").isNull()).drop("failure_code", "failure_detail")


def invalid_rows(validated: DataFrame, topic: str) -> DataFrame:
    """Invalid events tagged for the dead letter table as `code` or `code:value`."""
    reason = F.concat_ws(":", "failure_code", "failure_detail")
    return (validated.where(F.col("failure_code").isNotNull())
            .withColumn("failure_reason", reason).withColumn("source_topic", F.lit(topic))
            .drop("failure_code", "failure_detail"))
