from datetime import datetime, timedelta

from helpers import AS_OF, inventory_event, messages, order_event, payment_event
import pytest
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.sinks.tables import Store
from orderloom.sources.archive import replay
from orderloom.plans.daily import run_checks, run_summaries
from orderloom.streaming import job
from orderloom.streaming.job import process_batch
from orderloom.streaming.late import mark_late, newest_before


def snapshot(store):
    """All tables without what depends on the clock."""
    gold = {(r.order_id, r.payment_id, r.inventory_id, r.customer_id) for r in store.gold().collect()}
    dead = sorted((r.source_topic, r.failure_reason, r.raw_payload)
                  for r in store.dead_letters().collect())
    raw = {t: sorted((tuple(r[k] for k in S.TOPICS[t].raw_key), r.batch_id)
                     for r in store.raw(t).collect()) for t in S.TOPICS}
    counts = sorted((r.batch_id, r.input_rows, r.dlq_events, r.reconciled_rows, r.sla_violations)
                    for r in store.metrics().collect())
    return gold, dead, raw, counts


def run(spark, store, batch_id, *values, **kw):
    process_batch(messages(spark, *values), batch_id, store, as_of=AS_OF, **kw)


def test_late_payment_reopens_its_order_and_retries_change_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run(spark, store, 0, (S.ORDERS_TOPIC, order_event()), (S.INVENTORY_TOPIC, inventory_event()),
        (S.ORDERS_TOPIC, "junk"), (S.ORDERS_TOPIC, order_event(order_id="O2", total_amount=-1)))
    assert snapshot(store)[0] == {("O1", None, "I1", "C1")}
    for _ in range(2):
        run(spark, store, 1, (S.PAYMENTS_TOPIC, payment_event()),
            (S.ORDERS_TOPIC, order_event(customer_id="C2")))  # known key: the first row stays
    gold, dead, raw, counts = snapshot(store)
    assert gold == {("O1", "P1", "I1", "C1")}
    assert [d[:2] for d in dead] == [(S.ORDERS_TOPIC, "INVALID_AMOUNT:-1.0"),
                                     (S.ORDERS_TOPIC, "SCHEMA_PARSE_FAILED:order-events")]
    assert len(raw[S.ORDERS_TOPIC]) == 1
    assert counts == [(0, 4, 2, 1, 1), (1, 2, 0, 1, 0)]


def test_match_across_midnight(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run(spark, store, 0, (S.ORDERS_TOPIC, order_event(
        event_timestamp="2024-01-14T23:59:50.000000+00:00")))
    run(spark, store, 1, (S.PAYMENTS_TOPIC, payment_event(
        event_timestamp="2024-01-15T00:00:10.000000+00:00")))
    run(spark, store, 2, (S.INVENTORY_TOPIC, inventory_event(
        occurred_at="2024-01-14T23:59:55.000000+00:00")))
    assert snapshot(store)[0] == {("O1", "P1", "I1", "C1")}


def test_partners_before_their_order(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run(spark, store, 0, (S.PAYMENTS_TOPIC, payment_event(order_id="O1")),
        (S.PAYMENTS_TOPIC, payment_event(payment_id="P2", order_id=None)))
    assert snapshot(store)[0] == set()
    run(spark, store, 1, (S.ORDERS_TOPIC, order_event()))
    assert snapshot(store)[0] == {("O1", "P1", None, "C1")}


def test_late_events_go_to_the_dead_letters(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run(spark, store, 0, (S.ORDERS_TOPIC, order_event(
        event_timestamp="2024-01-15T10:10:00+00:00")))
    edge = order_event(order_id="EDGE", event_timestamp="2024-01-15T10:08:30+00:00")
    late = order_event(order_id="LATE", event_timestamp="2024-01-15T10:08:29+00:00")
    for _ in range(2):
        run(spark, store, 1, (S.ORDERS_TOPIC, edge), (S.ORDERS_TOPIC, late),
            (S.PAYMENTS_TOPIC, payment_event()))  # other topics have their own clock
    _, dead, raw, _ = snapshot(store)
    assert [d[1] for d in dead] == ["LATE_EVENT"] and "LATE" in dead[0][2]
    assert {k[0][0] for k in raw[S.ORDERS_TOPIC]} == {"O1", "EDGE"}
    assert len(raw[S.PAYMENTS_TOPIC]) == 1
    run(spark, store, 2, (S.ORDERS_TOPIC, late), late_after=None)
    assert "LATE" in {r.order_id for r in store.gold().collect()}


def test_empty_batch_writes_nothing_but_keeps_progress(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run(spark, store, 0, (S.ORDERS_TOPIC, order_event()))
    process_batch(messages(spark, (S.ORDERS_TOPIC, "x")).limit(0), 1, store, as_of=AS_OF)
    assert store.metrics().count() == 1
    assert newest_before(store, 2) == {S.ORDERS_TOPIC: 1705312800000000}
    with pytest.raises(ValueError):  # the folder before is absent
        newest_before(store, 5)


def test_archive_of_a_batch(spark, tmp_path):
    store = Store(spark, str(tmp_path / "tables"))
    run(spark, store, 0, (S.ORDERS_TOPIC, order_event()), (S.ORDERS_TOPIC, "junk"),
        archive_path=str(tmp_path / "archive"))
    kept = replay(spark, str(tmp_path / "archive" / S.ORDERS_TOPIC),
                  "order_id string, event_timestamp timestamp", "2024-01-15 10:00:00",
                  "2024-01-15 11:00:00")
    assert [(r.order_id, r.day, r.hour) for r in kept.collect()] == [("O1", 15, 10)]


def test_only_bad_messages(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    run(spark, store, 0, (S.ORDERS_TOPIC, "junk"), (S.PAYMENTS_TOPIC, None))
    assert store.dead_letters().count() == 2 and store.gold().count() == 0


def test_late_rule_over_stored_events(spark):
    rows = [(0, "t", 1, "10:00:00"), (1, "t", 2, "09:58:30"), (2, "t", 2, "09:58:29"),
            (3, "u", 2, "01:00:00"), (4, "t", 2, "11:00:00"), (5, "t", 3, "10:58:29")]
    df = spark.createDataFrame(rows, "id int, topic string, batch int, t string").select(
        "id", "topic", "batch", F.concat(F.lit("2024-01-15 "), "t").cast("timestamp")
        .alias("event_timestamp"))
    late = {r.id: r.late for r in mark_late(df).collect()}
    assert late == {0: False, 1: False, 2: True, 3: False, 4: False, 5: True}
    assert isinstance(mark_late(df).first().event_timestamp, datetime)


def test_orders_settled_without_a_partner_are_dead_letters_once(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    lonely = order_event(order_id="LONELY")
    later = order_event(order_id="NEW", event_timestamp="2024-01-15T10:30:00+00:00")
    run(spark, store, 0, (S.ORDERS_TOPIC, lonely), (S.ORDERS_TOPIC, order_event()),
        (S.PAYMENTS_TOPIC, payment_event()))
    assert snapshot(store)[1] == []  # nothing is settled yet
    for _ in range(2):
        run(spark, store, 1, (S.ORDERS_TOPIC, later))
        dead = snapshot(store)[1]
        assert [d[:2] for d in dead] == [("reconciler", "NO_PAYMENT_OR_INVENTORY_WITHIN_WINDOW")]
        assert "LONELY" in dead[0][2]
    old = order_event(order_id="OLD", event_timestamp="2024-01-15T09:00:00+00:00")
    run(spark, store, 2, (S.ORDERS_TOPIC, old), (S.PAYMENTS_TOPIC, payment_event(
        payment_id="P9", order_id="LONELY")), late_after=None)
    assert [("OLD" in d[2], "LONELY" in d[2]) for d in snapshot(store)[1]] in (
        [(True, False), (False, True)], [(False, True), (True, False)])
    assert ("LONELY", "P9", None, "C1") in snapshot(store)[0]  # a later match still counts


def test_a_retry_at_a_later_clock_is_the_same_batch(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    soon = order_event(event_timestamp="2024-01-15T12:10:00+00:00")
    now = datetime(2024, 1, 15, 12) - datetime(1970, 1, 1)
    for late in (timedelta(0), timedelta(hours=1)):
        micros = (now + late) // timedelta(microseconds=1)
        monkeypatch.setattr(job.time, "time_ns", lambda m=micros: m * 1000)
        process_batch(messages(spark, (S.ORDERS_TOPIC, soon)), 0, store)
    _, dead, raw, _ = snapshot(store)
    assert [d[1].split(":")[0] for d in dead] == ["FUTURE_TIMESTAMP"]
    assert raw[S.ORDERS_TOPIC] == []


def test_a_payment_after_compaction_finds_its_order(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    run(spark, store, 0, (S.ORDERS_TOPIC, order_event()))
    run(spark, store, 1, (S.INVENTORY_TOPIC, inventory_event()))
    store.compact_gold(str(tmp_path / "scratch"))
    run(spark, store, 2, (S.PAYMENTS_TOPIC, payment_event()))
    assert snapshot(store)[0] == {("O1", "P1", "I1", "C1")}


def test_messages_of_an_unknown_topic_are_kept(spark, tmp_path):
    sent = []
    store = Store(spark, str(tmp_path))
    run(spark, store, 0, ("elsewhere", order_event()),
        to_dead_letter_topic=lambda rows: sent.extend(rows.collect()))
    assert [d[:2] for d in snapshot(store)[1]] == [("elsewhere", "UNKNOWN_TOPIC")]
    assert len(sent) == 1 and b"elsewhere" in sent[0].value


def test_daily_jobs_over_a_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    run(spark, store, 0, (S.ORDERS_TOPIC, order_event()), (S.PAYMENTS_TOPIC, payment_event()),
        (S.ORDERS_TOPIC, "junk"))
    for _ in range(2):
        rows = run_checks(store, str(tmp_path / "checks"), datetime(2024, 1, 15, 12))
        run_summaries(store, str(tmp_path), datetime(2024, 1, 16, 1))
    found = {r.check_name: r.actual_value for r in rows.collect()}
    assert found["raw_order_events_24h"] == 1 and found["reconciliation_rate_24h"] == 100
    assert spark.read.parquet(str(tmp_path / "checks")).count() == len(found)
    hours = spark.read.parquet(str(tmp_path / "hourly_sla_summary")).collect()
    assert [(r.hour, r.total_orders, r.payment_sla_met) for r in hours] == [(10, 1, 1)]
    days = spark.read.parquet(str(tmp_path / "dlq_daily_summary")).collect()
    assert [(r.source_topic, r.event_count) for r in days] == [(S.ORDERS_TOPIC, 1)]
