"""Event streams derived from the TPC-H-like driver tables by plain arithmetic.

The driver data holds no payments or stock movements. These views give every order a life of events
so that each operator runs over whole tables whose size follows the data. The same rules in SQL are
in `orderloom.plans.oracle_views`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.session import use_utc

ORDERS_AS_OF = "2001-07-15 12:00:00"
EVENTS_AS_OF = "2024-01-30 12:00:00"
MESSAGES_AS_OF = "2001-08-03 00:00:00"
LATE_AS_OF = "2001-08-02 12:00:00"


SPREAD_BY = {"orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id"}


def table(spark: SparkSession, sf_dir: str, name: str, pieces: int | None = None) -> DataFrame:
    """A driver table, the large ones spread by their key.

    They come as a single row group, which would leave all that follows to one core. Without `pieces`
    adaptive execution merges small pieces by their bytes.
    """
    df = use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    if name not in SPREAD_BY:
        return df
    key = SPREAD_BY[name]
    return df.repartition(pieces, key) if pieces else df.repartition(key)


def even_pieces(spark: SparkSession) -> int:
    """Pieces for rows that take far more work than their bytes show, such as messages to be parsed.

    Merged by bytes they are a few long tasks, and most cores wait for the last of them.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               4 * spark.sparkContext.defaultParallelism)


def _shift(ts: str, seconds: str) -> Column:
    return F.expr(f"cast(timestampadd(SECOND, cast({seconds} as int), {ts}) as timestamp)")


def _plus_micros(ts: Column, micros: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + micros)


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def order_times(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    return table(spark, sf_dir, "orders", pieces).select(
        F.col("o_orderkey").alias("k"),
        _shift("o_orderdate", "o_orderkey % 86400").alias("ordered_at"),
        "o_custkey", "o_totalprice", "o_orderstatus")


def orders_ev(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    return order_times(spark, sf_dir, pieces).select(
        "k", F.concat(F.lit("ORD-"), _text("k")).alias("order_id"),
        F.when(F.col("k") % 5 == 0, "ORDER_UPDATED").otherwise("ORDER_CREATED").alias("event_type"),
        F.col("ordered_at").alias("event_timestamp"),
        _text("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
        F.lit("USD").alias("currency"), F.col("o_orderstatus").alias("status"),
        F.col("ordered_at").alias("ingested_at"))


def payments_ev(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    """No payment for a seventh of the orders, a second attempt for some of the others."""
    k = F.col("k")
    attempts = F.when(k % 13 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    paid_at = _plus_micros(_shift("ordered_at", "(k * 37 + attempt * 29) % 91"), k % 3 * 4000)
    return (
        order_times(spark, sf_dir, pieces).where(k % 7 != 0)
        .withColumn("attempt", F.explode(attempts))
        .select(
            "k", "attempt", F.concat(F.lit("PAY-"), _text("k"), F.lit("-"), _text("attempt"))
            .alias("payment_id"),
            F.when((k + F.col("attempt")) % 11 == 0, "PAYMENT_FAILED")
            .otherwise("PAYMENT_CONFIRMED").alias("event_type"),
            paid_at.alias("event_timestamp"),
            F.concat(F.lit("ORD-"), _text("k")).alias("order_id"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
            F.element_at(F.array(*[F.lit(g) for g in S.GATEWAYS]), (k % 4 + 1).cast("int"))
            .alias("gateway"),
            F.lit("done").alias("status"), paid_at.alias("ingested_at")))


def inventory_ev(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    line = table(spark, sf_dir, "lineitem", pieces).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    ids = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    moved_at = _plus_micros(_shift("ordered_at", "(l_partkey * 13 + l_linenumber) % 120"),
                            F.col("l_partkey") % 3 * 4000)
    orders = order_times(spark, sf_dir, pieces).select("k", "ordered_at")
    return line.join(orders, line.l_orderkey == orders.k).select(
        "k", "l_linenumber", "l_partkey",
        F.concat_ws("-", F.lit("INV"), *[_text(c) for c in ids]).alias("inventory_id"),
        F.when(F.col("l_linenumber") % 3 == 0, "INVENTORY_RELEASED")
        .otherwise("INVENTORY_RESERVED").alias("event_type"),
        moved_at.alias("event_timestamp"),
        F.concat(F.lit("ORD-"), _text("k")).alias("order_id"),
        _text("l_partkey").alias("sku"),
        (-F.col("l_quantity")).cast("int").alias("quantity_delta"),
        F.concat(F.lit("WH-"), (F.col("l_suppkey") % 5).cast("string")).alias("warehouse_id"),
        moved_at.alias("ingested_at"))


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = F.array(F.lit(S.ORDERS_TOPIC), F.lit(S.INVENTORY_TOPIC), F.lit(S.PAYMENTS_TOPIC))
    reasons = F.array(*[F.lit(r) for r in (
        "INVALID_AMOUNT", "MISSING_SKU", "FUTURE_TIMESTAMP", "UNKNOWN_GATEWAY", "INVALID_JSON")])
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    reason = F.element_at(reasons, (F.col("event_id") % 5 + 1).cast("int"))
    return events.select(
        F.element_at(topics, (F.col("user_id") % 3 + 1).cast("int")).alias("source_topic"),
        F.col("props").alias("raw_payload"),
        F.concat_ws(":", reason, "event_type").alias("failure_reason"),
        F.col("ts").cast("timestamp").alias("failed_at"))


def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pipeline batch per hour of the events table."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    return (table(spark, sf_dir, "events").groupBy(hour.alias("batch_timestamp")).agg(
        F.count("*").alias("input_rows"),
        F.count_if(F.col("event_type") == "error").alias("dlq_rows"),
        F.count_if(F.col("event_type") == "purchase").alias("reconciled_rows"),
        F.max((F.col("event_id") * 7919) % 90000).alias("processing_duration_ms"))
        .withColumn("batch_id", F.floor(F.unix_seconds("batch_timestamp") / 3600)))


# Faults put into the derived messages, chosen by (row number % 40).
FAULTS = 40


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _iso_short(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def _pick(fault: Column, usual: Column, **cases: Column) -> Column:
    """`usual`, but the value of case `fN` where the fault number is N."""
    out = usual
    for name, value in cases.items():
        out = F.when(fault == int(name[1:]), value).otherwise(out)
    return out


def _envelope(df: DataFrame, topic: str, value: Column, key: Column, at: Column) -> DataFrame:
    return df.select(
        key.cast("binary").alias("key"), value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"), F.pmod(F.col("row"), F.lit(3)).cast("int").alias("partition"),
        F.col("row").cast("bigint").alias("offset"), at.alias("timestamp"),
        F.lit(0).alias("timestampType"))


def _timed(fault: Column, ts: Column) -> Column:
    null = F.lit(None).cast("string")
    return _pick(
        fault, F.concat(_iso(ts), F.lit("+00:00")),
        f5=null, f11=F.lit("last tuesday"), f12=F.lit("2001-08-03T00:05:01+00:00"),
        f13=F.lit("2001-08-03T00:05:00+00:00"), f18=F.concat(_iso(ts), F.lit("Z")),
        f19=F.concat(_iso_short(ts), F.lit("+00:00")), f20=_iso_short(ts))


def order_messages(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    """Order events as JSON messages, many of them faulty in one of the ways of `FAULTS`."""
    null = F.lit(None).cast("string")
    df = (orders_ev(spark, sf_dir, pieces)
          .withColumn("row", F.col("k")).withColumn("fault", F.col("k") % FAULTS))
    fault = F.col("fault")
    fields = df.select(
        "*",
        _pick(fault, F.col("order_id"), f3=null, f14=F.lit("   "), f15=F.lit("\t"),
              f24=F.concat(F.col("order_id"), F.lit("-" + "x" * 50))).alias("m_id"),
        _pick(fault, F.col("event_type"), f7=null, f8=F.lit("ORDER_TELEPORTED"), f16=null)
        .alias("m_type"),
        _timed(fault, F.col("event_timestamp")).alias("m_time"),
        _pick(fault, F.lit("1.0"), f6=F.lit("99.0"), f16=F.lit("99.0"), f17=F.lit(""),
              f25=F.lit("2.0")).alias("m_version"),
        _pick(fault, F.col("total_amount").cast("double"), f9=F.lit(0.0), f10=F.lit(-1.0),
              f26=F.lit(None).cast("double"), f27=F.lit(123456789.5)).alias("m_amount"),
        _pick(fault, F.lit("USD"), f22=F.lit("EURO")).alias("m_currency"))

    def document(amount: Column) -> Column:
        return F.to_json(F.struct(
            F.col("m_id").alias("order_id"), F.col("m_type").alias("event_type"),
            F.col("m_time").alias("event_timestamp"), F.col("m_version").alias("schema_version"),
            F.col("customer_id"), amount.alias("total_amount"),
            F.col("m_currency").alias("currency"), F.col("status"),
            F.array(F.struct(F.lit("SKU-1").alias("sku"), F.lit(1).alias("quantity"),
                             F.col("m_amount").alias("unit_price"))).alias("items"),
            F.struct(F.lit("DE").alias("country")).alias("shipping_address"),
            F.lit("not in the schema").alias("extra")))

    value = _pick(fault, document(F.col("m_amount")), f1=F.lit("not json"), f2=F.lit(""),
                  f4=document(F.lit("not-a-number")), f21=F.lit("[1,2]"), f23=null)
    return _envelope(fields, S.ORDERS_TOPIC, value, F.col("order_id"), F.col("event_timestamp"))


def payment_messages(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    null = F.lit(None).cast("string")
    df = (payments_ev(spark, sf_dir, pieces)
          .withColumn("row", F.col("k") * 2 + F.col("attempt"))
          .withColumn("fault", F.col("k") % FAULTS)
          .withColumn("cents", (F.col("amount") * 100).cast("bigint") % 4900000 + 1))
    fault = F.col("fault")
    fields = df.select(
        "*",
        _pick(fault, F.col("payment_id"), f3=null, f14=F.lit("   ")).alias("m_id"),
        _pick(fault, F.col("event_type"), f6=F.lit("PAYMENT_CONFIRMED"), f7=null,
              f8=F.lit("PAYMENT_TELEPORTED"), f9=F.lit("PAYMENT_CONFIRMED"),
              f10=F.lit("PAYMENT_REFUNDED"), f26=F.lit("PAYMENT_CONFIRMED"),
              f28=F.lit("PAYMENT_FAILED")).alias("m_type"),
        _timed(fault, F.col("event_timestamp")).alias("m_time"),
        _pick(fault, (F.col("cents") / 100).cast("double"), f6=F.lit(-2.5), f9=F.lit(0.0),
              f10=F.lit(-1.0), f25=F.lit(50000.0), f26=F.lit(None).cast("double"),
              f27=F.lit(50000.01), f28=F.lit(0.0)).alias("m_amount"),
        _pick(fault, F.col("gateway"), f16=F.lit("CASHBOX"), f17=F.lit("")).alias("m_gateway"),
        _pick(fault, F.col("order_id"), f29=null).alias("m_order_id"),
        _pick(fault, F.lit("done"), f22=F.lit("a status far beyond twenty")).alias("m_status"))

    def document(amount: Column) -> Column:
        return F.to_json(F.struct(
            F.col("m_id").alias("payment_id"), F.col("m_type").alias("event_type"),
            F.col("m_time").alias("event_timestamp"), F.lit("1.0").alias("schema_version"),
            F.col("m_order_id").alias("order_id"), amount.alias("amount"),
            F.lit("USD").alias("currency"), F.col("m_gateway").alias("gateway"),
            F.col("m_status").alias("status"), F.lit(0.5).alias("gateway_fee")))

    value = _pick(fault, document(F.col("m_amount")), f1=F.lit("not json"), f2=F.lit(""),
                  f4=document(F.lit("not-a-number")), f21=F.lit("[1,2]"), f23=null)
    return _envelope(fields, S.PAYMENTS_TOPIC, value, F.col("payment_id"), F.col("event_timestamp"))


def inventory_messages(spark: SparkSession, sf_dir: str, pieces: int | None = None) -> DataFrame:
    null = F.lit(None).cast("string")
    df = (inventory_ev(spark, sf_dir, pieces)
          .withColumn("row", (F.col("k") * 7 + F.col("l_linenumber")) * 31 + F.col("l_partkey"))
          .withColumn("fault", F.col("row") % FAULTS))
    fault = F.col("fault")
    fields = df.select(
        "*",
        _pick(fault, F.col("inventory_id"), f3=null, f14=F.lit("   ")).alias("m_id"),
        _pick(fault, F.col("event_type"), f7=null, f8=F.lit("INVENTORY_TELEPORTED"))
        .alias("m_type"),
        _timed(fault, F.col("event_timestamp")).alias("m_time"),
        _pick(fault, F.col("sku"), f6=null, f16=F.lit(" \t")).alias("m_sku"),
        _pick(fault, F.col("quantity_delta"), f9=F.lit(0), f10=F.lit(10001), f25=F.lit(-10000),
              f26=F.lit(None).cast("int"), f27=F.lit(-10001)).alias("m_delta"),
        _pick(fault, F.col("warehouse_id"), f17=F.lit("WH-UNKNOWN"), f22=F.lit("W" * 51))
        .alias("m_warehouse"),
        _pick(fault, F.col("order_id"), f29=null).alias("m_order_id"))

    def document(delta: Column) -> Column:
        return F.to_json(F.struct(
            F.col("m_id").alias("inventory_id"), F.col("m_type").alias("event_type"),
            F.col("m_time").alias("occurred_at"), F.lit("1.0").alias("schema_version"),
            F.col("m_sku").alias("sku"), delta.alias("quantity_delta"),
            F.col("m_warehouse").alias("warehouse_id"), F.col("m_order_id").alias("order_id")))

    value = _pick(fault, document(F.col("m_delta")), f1=F.lit("not json"), f2=F.lit(""),
                  f4=document(F.lit("many")), f21=F.lit("[1,2]"), f23=null)
    return _envelope(fields, S.INVENTORY_TOPIC, value, F.col("inventory_id"),
                     F.col("event_timestamp"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (order_messages(spark, sf_dir).unionByName(payment_messages(spark, sf_dir))
            .unionByName(inventory_messages(spark, sf_dir)))


def gateway_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw gateway events as nested JSON, one per order."""
    kinds = ("payment_intent.succeeded", "payment_intent.payment_failed", "payment_intent.created",
             "payment_intent.canceled", "charge.dispute.created", "charge.refunded",
             "charge.succeeded", "charge.failed", "customer.created")
    null = F.lit(None).cast("string")
    k = F.col("k")
    df = order_times(spark, sf_dir).withColumn("row", k).withColumn(
        "kind", F.element_at(F.array(*[F.lit(x) for x in kinds]), (k % 9 + 1).cast("int")))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    charges = F.when(k % 3 == 0, F.array().cast("array<struct<id:string>>")).when(
        k % 3 == 1, F.array(F.struct(F.concat(F.lit("ch_"), _text("k")).alias("id")),
                            F.struct(F.lit("ch_later").alias("id"))))
    event_id = F.concat(F.lit("evt_"), _text("k"))
    inner = F.struct(
        F.concat(F.lit("pi_"), _text("k")).alias("id"),
        F.when(k % 17 != 0, cents).alias("amount"),
        F.when(k % 19 == 0, null).otherwise(F.lit("eur")).alias("currency"),
        F.lit("ok").alias("status"),
        F.create_map(F.lit("order_id"), F.when(k % 4 == 0, F.lit("")).otherwise(
            F.concat(F.lit("ORD-"), _text("k")))).alias("metadata"),
        F.struct(charges.alias("data")).alias("charges"),
        F.when(k % 9 == 1, F.struct(F.lit("card_declined").alias("code")))
        .alias("last_payment_error"))
    value = F.to_json(F.struct(
        event_id.alias("stripe_event_id"), F.col("kind").alias("event_type"),
        F.concat(_iso(F.col("ordered_at")), F.lit("+00:00")).alias("received_at"),
        F.lit("2023-10-16").alias("api_version"),
        F.struct(event_id.alias("id"), F.col("kind").alias("type"),
                 F.when(k % 23 != 0, F.unix_seconds("ordered_at")).alias("created"),
                 F.struct(inner.alias("object")).alias("data")).alias("raw_payload")))
    return _envelope(df, S.GATEWAY_TOPIC, value, event_id, F.col("ordered_at"))


def dead_letter_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the dead letter topic: tagged JSON, untagged JSON, arrays, text, nothing."""
    n = F.col("event_id")
    df = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts")
    ).withColumn("row", n)
    null = F.lit(None).cast("string")
    tagged = F.to_json(F.struct(
        F.concat(F.lit("REASON_"), F.upper("event_type")).alias("failure_reason"),
        F.lit(S.PAYMENTS_TOPIC).alias("source_topic"), n.alias("event_id")))
    value = (F.when(n % 10 == 0, F.lit("not json"))
             .when(n % 10 == 1, F.lit("[1,2]"))
             .when(n % 10 == 2, F.lit(""))
             .when(n % 10 == 3, null)
             .when(n % 10 == 4, F.lit('{"failure_reason":null,"x":1}'))
             .when(n % 10 == 5, F.to_json(F.struct(n.alias("event_id"))))
             .when(n % 10 == 6, F.to_json(F.struct(
                 F.repeat(F.lit("long"), 60).alias("failure_reason"))))
             .otherwise(tagged))
    return _envelope(df, S.DEAD_LETTER_TOPIC, value, n.cast("string"), F.col("ts"))
