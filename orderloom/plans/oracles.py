"""SQL for DuckDB that gives the same rows as each query."""

from __future__ import annotations

from orderloom.plans.oracle_views import (EVENTS_AS_OF, LATE_AS_OF, MESSAGES_AS_OF, ORDERS_AS_OF,
                                          inventory_codes, matched, order_codes, payment_codes,
                                          percent, with_views)

STREAMS = ("oe", "pe", "ie")
GOLD_VIEW = "order_id, event_timestamp, customer_id, payment_sla_met, inventory_sla_met"


def gold(body: str, as_of: str = ORDERS_AS_OF, *names: str, **extra: str) -> str:
    return with_views(body, *STREAMS, *names, gold=matched(as_of=as_of), **extra)


def messages(body: str, **extra: str) -> str:
    """All messages with topic, partition, offset and key."""
    union = """
        SELECT 'order-events' AS topic, rn, 'ORD-' || rn AS key, bad, f FROM om
        UNION ALL SELECT 'payment-events', rn, 'PAY-' || (rn // 2) || '-' || (rn % 2), bad, f
        FROM pmsg UNION ALL SELECT 'inventory-events', rn, NULL, bad, f FROM im"""
    return with_views(body, "om", "pmsg", "im", msg=union, **extra)


def _first_wins(view: str, key: str, fields: str, amount: str, number: str) -> str:
    return with_views(
        f"""SELECT {fields}, CAST({amount} AS DOUBLE) AS payload_amount,
                   {ORDERS_AS_OF} AS ingested_at, batch AS batch_id
            FROM (SELECT *, row_number() OVER (PARTITION BY {key}, event_type, event_timestamp
                      ORDER BY batch, seq, {amount}) AS pick FROM d) WHERE pick = 1""",
        view,
        d=f"""SELECT *, k % 2 AS batch, ({number}) * 10 AS seq FROM {view}
              UNION ALL SELECT * REPLACE ({amount} + 1 AS {amount}), 1, ({number}) * 10 + 1
              FROM {view} WHERE k % 10 IN (0, 3)""")


def _hourly(where: str) -> str:
    return f"""
        SELECT CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS summary_date,
               CAST(extract(hour FROM event_timestamp) AS INTEGER) AS hour,
               count(*) AS total_orders,
               count(*) FILTER (WHERE payment_sla_met) AS payment_sla_met,
               {percent("count(*) FILTER (WHERE payment_sla_met)", "count(*)")}
                   AS payment_sla_rate,
               count(*) FILTER (WHERE inventory_sla_met) AS inventory_sla_met,
               {percent("count(*) FILTER (WHERE inventory_sla_met)", "count(*)")}
                   AS inventory_sla_rate
        FROM gold WHERE {where} GROUP BY 1, 2"""


# The events of a view on three days in a row, at the time of day they had.
_MOVED = """
    SELECT * REPLACE (TIMESTAMP '2001-07-01' + to_microseconds(
        (k % 3) * 86400000000 + (k % 86400) * 1000000
        + (epoch_us(event_timestamp) - (k % 86400) * 1000000) % 86400000000) AS event_timestamp)
    FROM {}"""


def _day_before(day: str, column: str = "event_timestamp") -> str:
    return (f"{column} >= TIMESTAMP '{day}' - INTERVAL 1 DAY AND {column} < TIMESTAMP '{day}'")


def _check(name: str, as_of: str, status: str, expected: str, actual: str, details: str,
           source: str) -> str:
    return f"""
        SELECT {name} AS check_name, CAST(CAST({as_of} AS DATE) AS VARCHAR) AS check_date,
               {status} AS status, CAST({expected} AS DOUBLE) AS expected_value,
               CAST({actual} AS DOUBLE) AS actual_value, {details} AS details FROM {source}"""


_RAW = {
    "raw_order_events": "SELECT * REPLACE (CASE WHEN k % 9 <> 0 THEN total_amount END "
                        "AS total_amount) FROM oe",
    "raw_payment_events": "SELECT * REPLACE (CASE WHEN k % 16 <> 0 THEN order_id END "
                          "AS order_id) FROM pe",
    "raw_inventory_events": "SELECT * REPLACE (CASE WHEN k % 3 <> 0 THEN sku END AS sku) FROM ie",
}
_NULLS = {
    "raw_order_events": ("event_type", "event_timestamp", "total_amount"),
    "raw_payment_events": ("payment_id", "order_id"),
    "raw_inventory_events": ("sku", "quantity_delta"),
}


def _recent(table: str, as_of: str, column: str = "event_timestamp") -> str:
    return f"{table} WHERE {column} >= {as_of} - INTERVAL 1 DAY AND {column} <= {as_of}"


def _row_counts(as_of: str) -> str:
    return " UNION ALL ".join(
        _check(f"'{t}_24h'", as_of, "CASE WHEN n >= 10 THEN 'PASS' ELSE 'FAIL' END", "10", "n",
               "n || ' rows in the last 24 hours'",
               f"(SELECT count(*) AS n FROM {_recent(t, as_of)})") for t in _RAW)


def _null_rates(as_of: str) -> str:
    return " UNION ALL ".join(
        _check(f"'null_rate_{t}_{c}'", as_of, "CASE WHEN rate <= 10 THEN 'PASS' ELSE 'FAIL' END",
               "10", "rate", "format('{} of {} rows null, {:.2f} percent', nulls, n, rate)",
               f"""(SELECT n, nulls, coalesce({percent('nulls', 'n')}, 0) AS rate FROM
                   (SELECT count(*) AS n, count(*) FILTER (WHERE {c} IS NULL) AS nulls
                    FROM {_recent(t, as_of)}))""")
        for t, columns in _NULLS.items() for c in columns)


def _recon_rate(as_of: str) -> str:
    return _check(
        "'reconciliation_rate_24h'", as_of, "CASE WHEN rate > 0 THEN 'PASS' ELSE 'WARN' END",
        "NULL", "rate", "format('{} of {} orders have a payment, {:.2f} percent', paid, n, rate)",
        f"""(SELECT n, paid, coalesce({percent('paid', 'n')}, 0) AS rate FROM
            (SELECT count(*) AS n, count(payment_id) AS paid
             FROM {_recent('gold', as_of, 'reconciled_at')}))""")


_DLQ_GROWTH = _check(
    "'dlq_growth_rate'", EVENTS_AS_OF,
    "CASE WHEN y = 0 THEN 'PASS' WHEN t > 5 * y THEN 'FAIL' WHEN t > 2 * y THEN 'WARN' "
    "ELSE 'PASS' END", "1", "coalesce(((200 * t + y) // nullif(2 * y, 0)) / 100.0, 0)",
    "t || ' today, ' || y || ' the day before'",
    f"""(SELECT count(*) FILTER (WHERE failed_at >= date_trunc('day', {EVENTS_AS_OF})
                     AND failed_at <= {EVENTS_AS_OF}) AS t,
                count(*) FILTER (WHERE {_day_before('2024-01-30', 'failed_at')}) AS y FROM dl)""")

_DLQ_BREAKDOWN = _check(
    "'dlq_breakdown_24h'", EVENTS_AS_OF, "'INFO'", "NULL", "n", "line",
    f"""(SELECT sum(n) AS n, string_agg(source_topic || '/' || failure_reason || ':' || n, ', '
                ORDER BY n DESC, source_topic, failure_reason) AS line
         FROM (SELECT source_topic, failure_reason, count(*) AS n
               FROM {_recent('dl', EVENTS_AS_OF, 'failed_at')} GROUP BY 1, 2
               ORDER BY 3 DESC, 1, 2 LIMIT 10)) WHERE n > 0""")

_PIPELINE_SOURCE = f"""
    (SELECT count(*) AS n,
            (2 * sum(processing_duration_ms) + count(*)) // nullif(2 * count(*), 0) AS ms,
            ((2 * sum(rate4) + count(*)) // nullif(2 * count(*), 0)) / 10000.0 AS rate,
            max(batch_timestamp) AS last_at FROM {_recent('pm', EVENTS_AS_OF, 'batch_timestamp')})"""

_PIPELINE = " UNION ALL ".join([
    _check("'pipeline_batches_24h'", EVENTS_AS_OF,
           "CASE WHEN n > 0 THEN 'PASS' ELSE 'WARN' END", "1", "n",
           "n || ' batches in the last 24 hours, last ' || "
           "coalesce(strftime(last_at, '%Y-%m-%d %H:%M:%S'), 'never')", _PIPELINE_SOURCE),
    _check("'pipeline_processing_time'", EVENTS_AS_OF,
           "CASE WHEN ms < 60000 THEN 'PASS' ELSE 'WARN' END", "60000", "ms",
           "'average ' || ms || ' ms per batch'", _PIPELINE_SOURCE + " WHERE ms <> 0"),
    _check("'pipeline_failure_rate'", EVENTS_AS_OF,
           "CASE WHEN rate < 0.05 THEN 'PASS' ELSE 'WARN' END", "0.05", "rate",
           "format('average failure rate {:.4f}', rate)",
           _PIPELINE_SOURCE + " WHERE rate IS NOT NULL"),
])

_DLQ_INGEST = f"""
    SELECT source_topic, failure_reason, {EVENTS_AS_OF} AS failed_at, count(*) AS n,
           CAST(sum(payload_chars) AS BIGINT) AS payload_chars
    FROM (SELECT CASE WHEN event_id % 10 >= 7 THEN 'payment-events' ELSE 'dead-letter-events' END
                     AS source_topic,
                 CASE WHEN event_id % 10 <= 3 THEN 'INVALID_JSON'
                      WHEN event_id % 10 <= 5 THEN 'UNKNOWN'
                      WHEN event_id % 10 = 6 THEN repeat('long', 50)
                      ELSE 'REASON_' || upper(event_type) END AS failure_reason,
                 length(CASE event_id % 10 WHEN 0 THEN 'not json' WHEN 1 THEN '[1,2]' WHEN 2 THEN ''
                      WHEN 3 THEN '' WHEN 4 THEN '{{"failure_reason":null,"x":1}}'
                      WHEN 5 THEN '{{"event_id":' || event_id || '}}'
                      WHEN 6 THEN '{{"failure_reason":"' || repeat('long', 60) || '"}}'
                      ELSE '{{"failure_reason":"REASON_' || upper(event_type) ||
                           '","source_topic":"payment-events","event_id":' || event_id || '}}' END)
                     AS payload_chars FROM events)
    GROUP BY 1, 2, 3"""

_GATEWAY = """
    SELECT k, CASE k % 9 WHEN 0 THEN 'payment_intent.succeeded'
                WHEN 1 THEN 'payment_intent.payment_failed' WHEN 2 THEN 'payment_intent.created'
                WHEN 3 THEN 'payment_intent.canceled' WHEN 4 THEN 'charge.dispute.created'
                WHEN 5 THEN 'charge.refunded' WHEN 6 THEN 'charge.succeeded'
                WHEN 7 THEN 'charge.failed' ELSE 'customer.created' END AS kind,
           CASE k % 9 WHEN 0 THEN 'PAYMENT_CONFIRMED' WHEN 1 THEN 'PAYMENT_FAILED'
                WHEN 2 THEN 'PAYMENT_INITIATED' WHEN 3 THEN 'PAYMENT_CANCELLED'
                WHEN 4 THEN 'PAYMENT_DISPUTED' WHEN 5 THEN 'PAYMENT_REFUNDED'
                WHEN 6 THEN 'PAYMENT_CONFIRMED' WHEN 7 THEN 'PAYMENT_FAILED' END AS mapped,
           CASE WHEN k % 4 <> 0 THEN 'ORD-' || k
                ELSE 'ORD-' || upper(substr(sha256('evt_' || k), 1, 32)) END AS order_id,
           CASE WHEN k % 17 <> 0 THEN CAST(round(o_totalprice * 100) AS BIGINT) / 100 END AS amount,
           CASE WHEN k % 23 <> 0
                THEN strftime(ordered_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS event_timestamp
    FROM ot"""

_LATE_MESSAGES = f"""
    SELECT topic, part, m_ts, failure_code, bad FROM (
        SELECT 'order-events' AS topic, rn, f, broker_timestamp, m_ts, bad, failure_code
        FROM om LEFT JOIN (SELECT rn, failure_code FROM oc) USING (rn)
        UNION ALL SELECT 'payment-events', rn, f, broker_timestamp, m_ts, bad, failure_code
        FROM pmsg LEFT JOIN (SELECT rn, failure_code FROM pc) USING (rn)),
    LATERAL (SELECT CAST(CASE WHEN year(broker_timestamp) < 1997 THEN 0
                              WHEN year(broker_timestamp) < 1999 THEN 1 ELSE 2 END
                         + CASE WHEN rn % 50 = 7 THEN 1 ELSE 0 END AS BIGINT) AS part)"""


def _on_time(name: str, codes: str) -> dict[str, str]:
    """Valid messages of a topic with their batch and whether they come late, and those in time."""
    return {
        f"m{name}": f"""
            SELECT *, m_ts AS event_timestamp,
                   CAST(CASE WHEN year(broker_timestamp) < 1997 THEN 0
                             WHEN year(broker_timestamp) < 1999 THEN 1 ELSE 2 END
                        + CASE WHEN rn % 50 = 7 THEN 1 ELSE 0 END AS BIGINT) AS part
            FROM {codes} WHERE failure_code IS NULL""",
        f"l{name}": f"""
            SELECT m.*, coalesce(m_ts < newest - INTERVAL 90 SECOND, FALSE) AS late
            FROM m{name} m LEFT JOIN (
                SELECT a.part, max(b.newest) AS newest
                FROM (SELECT DISTINCT part FROM m{name}) a
                JOIN (SELECT part, max(m_ts) AS newest FROM m{name} GROUP BY 1) b ON b.part < a.part
                GROUP BY 1) USING (part)""",
        f"ot_{name}": f"SELECT * FROM l{name} WHERE NOT late",
    }


def oracles() -> dict[str, str]:
    codes = {"oc": order_codes(storage=True), "pc": payment_codes(storage=True),
             "ic": inventory_codes(storage=True)}
    stored = {
        "vo": "SELECT order_id, event_type, m_ts AS event_timestamp, customer_id, "
              "CAST(total_amount AS DECIMAL(10,2)) AS total_amount, status "
              "FROM oc WHERE failure_code IS NULL",
        "vp": "SELECT payment_id, event_type, m_ts AS event_timestamp, order_id, "
              "CAST(amount AS DECIMAL(10,2)) AS amount, gateway FROM pc WHERE failure_code IS NULL",
        "vi": "SELECT inventory_id, event_type, m_ts AS event_timestamp, order_id, sku "
              "FROM ic WHERE failure_code IS NULL",
    }
    msg_views = ("om", "pmsg", "im")
    # The same with the batch a message comes in; what batch n takes, and what it knows of partners.
    parts = {f"{v}b": stored[v].replace("FROM", ", source_offset % 3 AS part FROM") for v in stored}
    parts |= {f"o{n}": f"SELECT * FROM vob WHERE part = {n}" for n in range(3)}
    parts |= {f"{x}{n}": f"SELECT * FROM v{x}b WHERE part <= {n}" for x in "pi" for n in range(3)}
    topics = (("order-events", "om", "oc"), ("payment-events", "pmsg", "pc"),
              ("inventory-events", "im", "ic"))
    parse_failures = " UNION ALL ".join(
        f"""SELECT '{t}' AS source_topic, source_offset, 'SCHEMA_PARSE_FAILED:{t}' AS failure_reason,
                   broker_timestamp, f NOT IN (2, 23) AS has_value FROM {v} WHERE bad"""
        for t, v, _ in topics)
    lengths = " UNION ALL ".join(
        f"""SELECT '{t}' AS source_topic, source_offset, failure_code, {detail} AS failure_detail
            FROM {c} WHERE failure_code IN ('VALUE_TOO_LONG', 'VALUE_OUT_OF_RANGE')"""
        for (t, _, c), detail in zip(topics, (
            "CASE f WHEN 24 THEN 'order_id' WHEN 22 THEN 'currency' ELSE 'total_amount' END",
            "'status'", "'warehouse_id'")))
    rejected = " UNION ALL ".join(
        f"""SELECT '{t}' AS source_topic, 'SCHEMA_PARSE_FAILED' AS failure_code FROM {v} WHERE bad
            UNION ALL SELECT '{t}', failure_code FROM {c} WHERE failure_code IS NOT NULL"""
        for t, v, c in topics)
    gateway_rows = """
        SELECT 'pi_' || k AS payment_id, mapped AS event_type, event_timestamp,
               '1.0' AS schema_version, order_id, amount,
               CASE WHEN k % 19 = 0 THEN '' ELSE 'EUR' END AS currency, 'STRIPE' AS gateway,
               'ok' AS status, 'evt_' || k AS gateway_event_id,
               CASE WHEN k % 3 = 1 THEN 'ch_' || k END AS gateway_transaction_id,
               CASE WHEN k % 9 = 1 THEN 'card_declined' END AS failure_reason,
               kind AS raw_stripe_event
        FROM g WHERE mapped IS NOT NULL"""
    archived = """
        SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
               CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
               count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1, 2, 3, 4"""
    unbounded = f"""
        SELECT o.order_id, o.event_timestamp, o.customer_id,
               CAST(o.total_amount AS DOUBLE) AS total_amount, o.status AS order_status,
               p.payment_id, p.event_timestamp AS payment_confirmed_at,
               p.gateway AS payment_gateway, CAST(p.amount AS DOUBLE) AS payment_amount,
               coalesce(date_diff('microsecond', o.event_timestamp, p.event_timestamp) <= 60000000,
                        FALSE) AS payment_sla_met,
               round(date_diff('microsecond', o.event_timestamp, p.event_timestamp) / 1e6, 2)
                   AS payment_latency_seconds,
               i.inventory_id, i.event_timestamp AS inventory_reserved_at, i.sku,
               coalesce(date_diff('microsecond', o.event_timestamp, i.event_timestamp) <= 60000000,
                        FALSE) AS inventory_sla_met,
               round(date_diff('microsecond', o.event_timestamp, i.event_timestamp) / 1e6, 2)
                   AS inventory_latency_seconds,
               {ORDERS_AS_OF} AS reconciled_at, coalesce(p.n, 0) AS payment_matches,
               coalesce(i.n, 0) AS inventory_matches
        FROM oe o
        LEFT JOIN (SELECT *, count(*) OVER (PARTITION BY order_id) AS n, row_number() OVER (
                       PARTITION BY order_id ORDER BY event_timestamp, payment_id) AS pick
                   FROM pe) p ON p.order_id = o.order_id AND p.pick = 1
        LEFT JOIN (SELECT *, count(*) OVER (PARTITION BY order_id) AS n, row_number() OVER (
                       PARTITION BY order_id ORDER BY event_timestamp, inventory_id, sku) AS pick
                   FROM ie WHERE event_type = 'INVENTORY_RESERVED') i
             ON i.order_id = o.order_id AND i.pick = 1"""
    legs = """
        SELECT l.order_id, leg, leg_id, l.event_type, leg_at, o.event_timestamp AS ordered_at,
               round(date_diff('microsecond', o.event_timestamp, leg_at) / 1e6, 2)
                   AS latency_seconds,
               coalesce(date_diff('microsecond', o.event_timestamp, leg_at) <= 60000000, FALSE)
                   AS sla_met
        FROM (SELECT order_id, 'payment' AS leg, payment_id AS leg_id, event_type,
                     event_timestamp AS leg_at FROM pe
              UNION ALL SELECT order_id, 'inventory', inventory_id, event_type, event_timestamp
              FROM ie WHERE event_type = 'INVENTORY_RESERVED') l
        LEFT JOIN oe o ON o.order_id = l.order_id"""
    upsert = """
        SELECT a.order_id, a.event_timestamp, a.customer_id, a.total_amount, a.order_status,
               coalesce(b.reconciled_at, a.reconciled_at) AS reconciled_at, """ + ", ".join(
        f"CASE WHEN b.order_id IS NULL THEN a.{c} ELSE b.{c} END AS {c}" for c in (
            "payment_id", "payment_confirmed_at", "payment_gateway", "payment_amount",
            "payment_sla_met", "payment_latency_seconds", "inventory_id", "inventory_reserved_at",
            "sku", "inventory_sla_met", "inventory_latency_seconds")) + """
        FROM a LEFT JOIN b USING (order_id, event_timestamp)"""
    upserted = {
        "p0": "SELECT * FROM pe WHERE attempt = 0", "i0": "SELECT * FROM ie WHERE l_linenumber < 3",
        "a": matched("oe", "p0", "i0", "TIMESTAMP '2001-07-15 11:00:00'"),
        "o1": "SELECT * FROM oe WHERE k % 3 <> 0", "b": matched("o1")}
    payment_fields = "payment_id, event_type, event_timestamp, order_id, amount, gateway, status"
    inventory_fields = ("inventory_id, event_type, event_timestamp, order_id, sku, quantity_delta, "
                        "warehouse_id")
    late_codes = {"oc": order_codes(LATE_AS_OF, True), "pc": payment_codes(LATE_AS_OF, True)}
    topic_counts = "SELECT topic, count(*) AS n FROM msg GROUP BY 1"

    return {
        "src_single_topic": messages(
            """SELECT topic, CAST(rn % 3 AS INTEGER) AS partition, rn AS "offset", key FROM msg
               WHERE topic = 'payment-events'"""),
        "src_multi_topic": messages(
            """SELECT topic, CAST(rn % 3 AS INTEGER) AS partition, rn % 2 AS batch_id,
                      count(*) AS n, CAST(sum(rn) AS BIGINT) AS offsets
               FROM msg GROUP BY 1, 2, 3"""),
        "dlq_ingest": _DLQ_INGEST,
        "stream_dlq_ingest": _DLQ_INGEST,
        "archive_partitions": archived,
        "archive_replay": """
            SELECT event_id, ts AS event_timestamp, event_type FROM events
            WHERE ts >= TIMESTAMP '2024-01-10 05:30:00' AND ts < TIMESTAMP '2024-01-12 17:45:00'""",
        "raw_orders_first_wins": _first_wins(
            "oe", "order_id", "order_id, event_type, event_timestamp, customer_id, "
            "CAST(total_amount AS DOUBLE) AS total_amount, currency, status", "total_amount", "k"),
        "raw_payments_first_wins": _first_wins(
            "pe", "payment_id", payment_fields.replace(
                "amount", "CAST(amount AS DOUBLE) AS amount"), "amount", "k"),
        "raw_inventory_first_wins": _first_wins(
            "ie", "inventory_id", inventory_fields, "quantity_delta", "k * 100 - quantity_delta"),
        "gold_upsert": with_views(upsert, *STREAMS, **upserted),
        "customer_lookup": with_views(f"{upsert} WHERE a.customer_id = '77'", *STREAMS, **upserted),
        "order_lookup": with_views(
            """SELECT * FROM v WHERE order_id = (
                   SELECT order_id FROM a WHERE customer_id = '77'
                   ORDER BY event_timestamp DESC, order_id LIMIT 1)""", *STREAMS, **upserted,
            v="""SELECT *, CAST(0 AS BIGINT) AS batch_id FROM a UNION ALL
                 SELECT * REPLACE ('moved-' || customer_id AS customer_id,
                                   total_amount + 5 AS total_amount), 1 FROM b"""),
        "archive_backfill": with_views(
            matched("o3", "p3", "i3", MESSAGES_AS_OF), *STREAMS,
            o3=_MOVED.format("oe"), i3=_MOVED.format("ie"),
            p3=f"""SELECT * REPLACE (CAST((CAST(amount * 100 AS BIGINT) % 4900000 + 1) / 100
                       AS DECIMAL(10,2)) AS amount) FROM ({_MOVED.format("pe")})"""),
        "raw_payload_variant": with_views(
            """SELECT source_offset, f NOT IN (1, 2, 23) AS is_json,
                      CASE WHEN object THEN order_id END AS order_id,
                      CASE WHEN object THEN event_type END AS event_type,
                      CASE WHEN object THEN m_time END AS event_time,
                      CASE WHEN object THEN schema_version END AS schema_version,
                      CASE WHEN object THEN customer_id END AS customer_id,
                      CASE WHEN object AND f <> 4 THEN total_amount END AS total_amount,
                      CASE WHEN f = 25 THEN 'not in the schema' WHEN object THEN currency END
                          AS currency,
                      CASE WHEN object THEN 1 END AS quantity,
                      CASE WHEN object THEN 'DE' END AS country,
                      CASE WHEN object AND f <> 25 THEN '{"extra":"not in the schema"}' END
                          AS unknown
               FROM (SELECT *, f NOT IN (1, 2, 21, 23) AS object FROM om)""", "om"),
        "pipeline_metrics_rate": with_views(
            """SELECT batch_id, batch_timestamp, input_rows, dlq_rows AS dlq_events,
                      dlq_rows AS reconciliation_failures,
                      rate4 / 10000.0 AS reconciliation_failure_rate, reconciled_rows,
                      processing_duration_ms FROM pm""", "pm"),
        "summary_rerun_idempotent": gold(_hourly(
            f"({_day_before('2001-07-15')}) OR ({_day_before('2001-07-14')})")),
        "parse_orders": with_views(
            """SELECT source_offset, order_id, event_type, m_time AS event_timestamp,
                      schema_version, customer_id, total_amount, currency, status, 1 AS n_items,
                      'DE' AS country, broker_timestamp FROM om WHERE NOT bad""", "om"),
        "parse_payments": with_views(
            """SELECT source_offset, payment_id, event_type, m_time AS event_timestamp, order_id,
                      amount, gateway, status, broker_timestamp FROM pmsg WHERE NOT bad""", "pmsg"),
        "parse_inventory": with_views(
            """SELECT source_offset, inventory_id, event_type, m_time AS occurred_at, sku,
                      quantity_delta, warehouse_id, order_id, broker_timestamp
               FROM im WHERE NOT bad""", "im"),
        "parse_failures": with_views(parse_failures, *msg_views),
        "parse_lenient": with_views(
            """SELECT source_offset, CASE WHEN f = 4 THEN 'ORD-' || rn ELSE order_id END AS order_id,
                      CASE WHEN f <> 4 THEN total_amount END AS total_amount
               FROM om WHERE NOT bad OR f = 4""", "om"),
        "route_by_topic": messages(
            """SELECT topic, CAST(rn % 3 AS INTEGER) AS partition, rn AS "offset" FROM msg
               WHERE topic = 'inventory-events'"""),
        "normalise_orders": with_views(
            "SELECT source_offset, order_id, m_ts AS event_timestamp FROM om WHERE NOT bad", "om"),
        "normalise_inventory": with_views(
            "SELECT source_offset, inventory_id, m_ts AS event_timestamp FROM im WHERE NOT bad",
            "im"),
        "normalise_payments": with_views(
            "SELECT source_offset, payment_id, m_ts AS event_timestamp FROM pmsg WHERE NOT bad",
            "pmsg"),
        "validate_orders": with_views(
            "SELECT source_offset, order_id, failure_code FROM oc", "om", oc=order_codes()),
        "validate_inventory": with_views(
            "SELECT source_offset, inventory_id, failure_code FROM ic", "im", ic=inventory_codes()),
        "validate_payments": with_views(
            "SELECT source_offset, payment_id, failure_code FROM pc", "pmsg", pc=payment_codes()),
        "validate_lengths": with_views(lengths, *msg_views, **codes),
        "dlq_from_invalid": with_views(
            f"""SELECT source_topic, failure_code, {MESSAGES_AS_OF} AS failed_at, count(*) AS n
                FROM rejected GROUP BY 1, 2, 3""", *msg_views, **codes, rejected=rejected),
        "gateway_flatten": with_views(gateway_rows, "ot", g=_GATEWAY),
        "gateway_type_map": with_views(
            """SELECT kind AS gateway_type, mapped AS payment_type, count(*) AS n FROM g
               WHERE mapped IS NOT NULL GROUP BY 1, 2""", "ot", g=_GATEWAY),
        "gateway_two_stage": with_views(
            """SELECT 'pi_' || k AS payment_id, mapped AS event_type, order_id, amount
               FROM g WHERE mapped IS NOT NULL
               UNION ALL SELECT 'evt_' || k, 'RAW', NULL, NULL FROM g""", "ot", g=_GATEWAY),
        "reconcile": with_views(matched(), *STREAMS),
        "stream_reconcile": with_views(matched(), *STREAMS),
        "incremental_reconcile": with_views(matched(), *STREAMS),
        "recon_wide_window": with_views(
            matched(window=120, sla=60, inventory_sla=45), *STREAMS),
        "recon_unbounded": with_views(unbounded, *STREAMS),
        "recon_legs": with_views(legs, *STREAMS),
        "recon_terminal": with_views(
            """SELECT payment_id, order_id, event_type, event_timestamp,
                      CAST(amount AS DOUBLE) AS amount FROM pe
               WHERE event_type IN ('PAYMENT_CONFIRMED', 'PAYMENT_FAILED', 'PAYMENT_DISPUTED',
                                    'PAYMENT_REFUNDED')""", "pe"),
        "recon_matched": gold(
            """SELECT order_id, event_timestamp, payment_id, inventory_id FROM gold
               WHERE payment_id IS NOT NULL OR inventory_id IS NOT NULL"""),
        "recon_dlq_candidates": gold(
            f"""SELECT order_id, event_timestamp, customer_id, total_amount,
                       'NO_PAYMENT_OR_INVENTORY_WITHIN_WINDOW' AS failure_reason,
                       'reconciler' AS source_topic FROM gold
                WHERE payment_id IS NULL AND inventory_id IS NULL
                  AND event_timestamp < {ORDERS_AS_OF}"""),
        "check_row_counts": with_views(_row_counts(ORDERS_AS_OF), *STREAMS, **_RAW),
        "check_null_rates": with_views(_null_rates(ORDERS_AS_OF), *STREAMS, **_RAW),
        "check_recon_rate": gold(_recon_rate(ORDERS_AS_OF)),
        "check_dlq_growth": with_views(_DLQ_GROWTH, "dl"),
        "check_dlq_breakdown": with_views(_DLQ_BREAKDOWN, "dl"),
        "check_pipeline_metrics": with_views(_PIPELINE, "pm"),
        "quality_all": with_views(
            " UNION ALL ".join([_row_counts(EVENTS_AS_OF), _null_rates(EVENTS_AS_OF),
                                _recon_rate(EVENTS_AS_OF), _DLQ_GROWTH, _DLQ_BREAKDOWN, _PIPELINE]),
            *STREAMS, "dl", "pm", **_RAW, gold=matched(as_of=EVENTS_AS_OF)),
        "hourly_sla_changes": gold(_hourly("TRUE")),
        "recon_rate_changes": gold(" UNION ALL ".join(
            _recon_rate(as_of).replace("FROM gold", f"FROM {view}") for as_of, view in (
                (ORDERS_AS_OF, "now"), ("TIMESTAMP '2001-07-15 11:30:00'", "now"),
                ("TIMESTAMP '2001-07-16 11:30:00'", "now"))), now="""
            SELECT * REPLACE (
                CASE WHEN year(event_timestamp) < 1998 AND CAST(substr(order_id, 5) AS BIGINT) % 4 <> 0
                     THEN TIMESTAMP '2001-07-15 11:00:00' ELSE reconciled_at END AS reconciled_at)
            FROM gold"""),
        "raw_profiles": with_views(
            f"""SELECT 'raw_order_events' AS table_name, name AS column_name,
                       CASE WHEN name IS NULL THEN count(*) WHEN name = 'status' THEN 0
                            ELSE count(*) FILTER (WHERE total_amount IS NULL) END AS n,
                       {ORDERS_AS_OF} AS ingested_at, batch AS batch_id
                FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY batch, seq) AS pick FROM d),
                     (VALUES (NULL), ('total_amount'), ('status')) c(name)
                WHERE pick = 1 GROUP BY name, batch""", "oe",
            d="""SELECT k, CASE WHEN k % 9 <> 0 THEN total_amount END AS total_amount,
                        k % 2 AS batch, k * 10 AS seq FROM oe
                 UNION ALL SELECT k, CASE WHEN k % 9 <> 0 THEN total_amount END, 1, k * 10 + 1
                 FROM oe WHERE k % 10 IN (0, 3)"""),
        "hourly_sla_summary": gold(_hourly(_day_before("2001-07-15"))),
        "hourly_sla_backfill": gold(_hourly("TRUE")),
        "stream_hourly_sla": gold(_hourly("TRUE")),
        "dlq_daily_summary": with_views(
            f"""SELECT CAST(CAST(failed_at AS DATE) AS VARCHAR) AS summary_date, source_topic,
                       failure_reason, count(*) AS event_count FROM dl
                WHERE {_day_before('2024-01-30', 'failed_at')} GROUP BY 1, 2, 3""", "dl"),
        "batch_topic_counts": messages(topic_counts),
        "table_counts": gold(" UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS n FROM {view}" for name, view in (
                ("raw_order_events", "oe"), ("raw_payment_events", "pe"),
                ("raw_inventory_events", "ie"), ("dead_letter_events", "dl"),
                ("reconciled_order_events", "gold"))), ORDERS_AS_OF, "dl"),
        "orders_for_customer": gold(f"SELECT {GOLD_VIEW} FROM gold WHERE customer_id = '77'"),
        "recent_orders": gold(
            f"SELECT {GOLD_VIEW} FROM gold WHERE event_timestamp >= TIMESTAMP '2001-06-01'"),
        "sla_misses": gold(
            f"SELECT {GOLD_VIEW} FROM gold WHERE NOT payment_sla_met OR NOT inventory_sla_met"),
        "dlq_by_topic": with_views(
            """SELECT source_topic, raw_payload, failure_reason, failed_at FROM dl
               WHERE source_topic = 'payment-events'""", "dl"),
        "stream_end_to_end": with_views(
            matched("vo", "vp", "vi", MESSAGES_AS_OF), *msg_views, **codes, **stored),
        "stream_late_to_dlq": with_views(
            """SELECT topic AS source_topic, part AS batch_id,
                      CASE WHEN bad THEN 'SCHEMA_PARSE_FAILED'
                           ELSE coalesce(failure_code, 'LATE_EVENT') END AS failure_code,
                      count(*) AS n
               FROM lm LEFT JOIN before USING (topic, part)
               WHERE bad OR failure_code IS NOT NULL OR m_ts < newest - INTERVAL 90 SECOND
               GROUP BY 1, 2, 3""", "om", "pmsg", **late_codes, lm=_LATE_MESSAGES,
            before="""SELECT n.topic, n.part, max(m.m_ts) AS newest
                      FROM (SELECT DISTINCT topic, part FROM lm) n
                      JOIN lm m ON m.topic = n.topic AND m.part < n.part
                           AND NOT m.bad AND m.failure_code IS NULL GROUP BY 1, 2"""),
        "stream_match_on_time": with_views(
            f"""SELECT 'gold' AS kind, order_id AS id, event_timestamp, payment_id,
                       payment_latency_seconds, inventory_id, sku, inventory_sla_met,
                       CAST(NULL AS BIGINT) AS batch_id
                FROM ({matched('ot_o', 'ot_p', 'ot_i', LATE_AS_OF)})""" + "".join(
                f""" UNION ALL SELECT '{t}', {i}, NULL, NULL, NULL, NULL, NULL, NULL, part
                     FROM l{x} WHERE late""" for t, x, i in (
                    ("order-events", "o", "order_id"), ("payment-events", "p", "payment_id"),
                    ("inventory-events", "i", "inventory_id"))),
            *msg_views, **late_codes, ic=inventory_codes(LATE_AS_OF, True), **_on_time("o", "oc"),
            **_on_time("p", "pc"), **_on_time("i", "ic")),
        "stream_unmatched_to_dlq": with_views(
            " UNION ALL ".join(
                f"""SELECT order_id, event_timestamp, CAST({n} AS BIGINT) AS batch_id
                    FROM ({matched(f'o{n}', f'p{n}', f'i{n}', MESSAGES_AS_OF)})
                    WHERE payment_id IS NULL AND inventory_id IS NULL AND event_timestamp <
                      (SELECT greatest(max(o.t), max(p.t), max(i.t)) FROM
                         (SELECT max(event_timestamp) AS t FROM vob WHERE part <= {n}) o,
                         (SELECT max(event_timestamp) AS t FROM vpb WHERE part <= {n}) p,
                         (SELECT max(event_timestamp) AS t FROM vib WHERE part <= {n}) i)
                      - INTERVAL 150 SECOND""" for n in range(3)), *msg_views, **codes, **parts),
        "late_events": """
            WITH e AS (SELECT event_id, 'topic-' || (user_id % 3) AS topic,
                              date_trunc('hour', ts) AS batch,
                              ts - to_seconds((event_id * 37) % 200) AS event_timestamp FROM events),
            n AS (SELECT topic, batch, max(event_timestamp) AS newest FROM e GROUP BY 1, 2),
            b AS (SELECT topic, batch, max(newest) OVER (PARTITION BY topic ORDER BY batch
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM n)
            SELECT event_id, topic, event_timestamp,
                   coalesce(event_timestamp < newest - INTERVAL 90 SECOND, FALSE) AS late
            FROM e JOIN b USING (topic, batch)""",
        "stream_dedup": with_views(
            "SELECT DISTINCT order_id, event_type, event_timestamp FROM oe", "oe"),
        "stream_progress_metrics": with_views(
            """SELECT n AS input_rows, coalesce(date_trunc('millisecond', max(newest) OVER (
                          ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
                          - INTERVAL 90 SECOND, TIMESTAMP '1970-01-01') AS watermark,
                      CAST(0 AS BIGINT) AS late_rows, n AS observed_rows, newest AS observed_newest
               FROM (SELECT CASE WHEN year(event_timestamp) < 1997 THEN 0
                                 WHEN year(event_timestamp) < 1999 THEN 1 ELSE 2 END AS part,
                            count(*) AS n, max(event_timestamp) AS newest FROM oe GROUP BY 1)""", "oe"),
    }
