"""What batches store about themselves, time zones of the driver, late rows before a stream with state."""

import time
from datetime import datetime, timedelta, timezone

import pytest
from helpers import inventory_event, messages, order_event, payment_event
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.functions.times import moment, utc
from orderloom.plans import daily, quality, summary
from orderloom.plans.daily import run_checks, run_summaries
from orderloom.session import use_utc
from orderloom.sinks.tables import Store, move_folder
from orderloom.streaming import intake, progress, streams
from orderloom.streaming.job import process_batch

NOON = datetime(2024, 1, 15, 12)


@pytest.fixture(params=["America/New_York", "Asia/Tokyo"])
def elsewhere(request, monkeypatch):
    monkeypatch.setenv("TZ", request.param)
    time.tzset()
    yield
    monkeypatch.undo()
    time.tzset()


def run(spark, store, batch_id, *values, as_of=NOON, **kw):
    process_batch(messages(spark, *values), batch_id, store, as_of=as_of, **kw)


def test_limits_are_utc_wherever_the_driver_is(spark, tmp_path, elsewhere):
    use_utc(spark)
    store = Store(spark, str(tmp_path))
    run(spark, store, 0, (S.ORDERS_TOPIC, order_event(order_id="LONELY")), (S.ORDERS_TOPIC, "junk"))
    run(spark, store, 1, (S.ORDERS_TOPIC, order_event(
        order_id="NEW", event_timestamp="2024-01-15T10:30:00+00:00")))
    dead = sorted(r.source_topic for r in store.dead_letters().collect())
    assert dead == [S.ORDERS_TOPIC, "reconciler"]
    five = timezone(timedelta(hours=5))
    minute = timedelta(minutes=1)
    for low, high in ((NOON - minute, NOON + minute), ("2024-01-15 11:59:00", "2024-01-15T12:01:00"),
                      (datetime(2024, 1, 15, 16, 59, tzinfo=five), datetime(2024, 1, 15, 17, 1, tzinfo=five)),
                      (moment(NOON - minute), moment(NOON + minute))):
        assert store.dead_letters(low, high).count() == 2
        assert store.metrics(low, high).count() == 2
    assert store.dead_letters(NOON + minute, NOON + 2 * minute).count() == 0
    assert store.gold(datetime(2024, 1, 15, 10), datetime(2024, 1, 15, 10, 1)).count() == 1
    late_evening = datetime(2024, 1, 16, 4, tzinfo=five)  # 23 o'clock of the day in UTC
    found = {r.check_name: r.actual_value for r in run_checks(
        store, str(tmp_path / "checks"), late_evening).collect()}
    assert found["raw_order_events_24h"] == 2 and found["pipeline_batches_24h"] == 2
    assert utc("2024-01-16T04:00:00+05:00") == utc(late_evening) == datetime(2024, 1, 15, 23)


def test_daily_jobs_from_what_batches_stored(spark, tmp_path, monkeypatch):
    """The checks and summaries equal those of a scan, also after reopened orders; no scan is made."""
    store = Store(spark, str(tmp_path / "store"))
    hour = timedelta(hours=1)
    run(spark, store, 0, (S.ORDERS_TOPIC, order_event()), (S.ORDERS_TOPIC, order_event(order_id="O2")),
        (S.ORDERS_TOPIC, "junk"), (S.INVENTORY_TOPIC, inventory_event(order_id=None)),
        as_of=NOON - 1.5 * hour)
    late = [(S.PAYMENTS_TOPIC, payment_event()), (S.ORDERS_TOPIC, order_event(
        order_id="O3", event_timestamp="2024-01-14T23:59:30+00:00")),
        (S.ORDERS_TOPIC, order_event()), (S.INVENTORY_TOPIC, inventory_event(sku=None))]
    for _ in range(2):
        run(spark, store, 1, *late, as_of=NOON, late_after=None)
    run(spark, store, 2, (S.PAYMENTS_TOPIC, "junk"), (S.INVENTORY_TOPIC, inventory_event(
        inventory_id="I2")), as_of=NOON + hour, late_after=None)
    tables = {spec.raw_table: store.raw(t) for t, spec in S.TOPICS.items()}

    def plain(df):
        return sorted(map(tuple, df.collect()), key=repr)

    for as_of in (NOON - hour, NOON, NOON + hour, NOON + 22.6 * hour, NOON + 24 * hour, NOON + 99 * hour):
        want = quality.all_checks(tables, store.gold(), store.dead_letters(), store.metrics(), as_of)
        got = quality.stored_checks(store.raw_profiles(), store.gold_clocks(),
                                    store.dead_letter_counts(), store.metrics(), as_of)
        assert plain(got) == plain(want), as_of
    assert plain(summary.hourly_sla_of(store.gold_hours())) == plain(summary.hourly_sla(store.gold()))
    assert plain(summary.dlq_daily(store.dead_letter_counts())) == plain(
        summary.dlq_daily(store.dead_letters()))

    read = []
    for name in ("raw", "raw_of", "gold", "gold_versions", "gold_of", "dead_letters"):
        monkeypatch.setattr(Store, name, lambda *a, name=name, **k: read.append(name))
    run_checks(store, str(tmp_path / "checks"), NOON)
    run_summaries(store, str(tmp_path), NOON + 12 * hour)
    assert read == []
    hours = spark.read.parquet(str(tmp_path / "hourly_sla_summary")).collect()
    assert [(r.hour, r.total_orders, r.payment_sla_met) for r in hours] == [(10, 2, 1)]


def test_daily_jobs_list_their_days_only(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for n in range(4):
        day = NOON - timedelta(days=n)
        store.add_raw_profiles({S.ORDERS_TOPIC: {"rows": 7, "status": n}}, n, day)
    df = store.raw_profiles(NOON - daily.DAY, NOON + daily.INSTANT)
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.relation().location().rootPaths().size() == 2
    assert sorted((r.column_name or "", r.n) for r in df.collect()) == [
        ("", 7), ("", 7), ("status", 0), ("status", 1)]


def test_intake_sends_late_rows_to_the_dead_letters(spark, tmp_path):
    store, path = Store(spark, str(tmp_path / "tables")), str(tmp_path / "accepted")
    first = messages(spark, (S.ORDERS_TOPIC, order_event(event_timestamp="2024-01-15T10:10:00+00:00")),
                     (S.PAYMENTS_TOPIC, payment_event()), ("elsewhere", order_event()))
    late = messages(spark, (S.ORDERS_TOPIC, order_event(order_id="LATE")), (S.ORDERS_TOPIC, order_event(
        order_id="EDGE", event_timestamp="2024-01-15T10:08:30+00:00")))
    for batch, rows in ((0, first), (1, late), (1, late)):
        intake.accept_batch(rows, batch, store, path, as_of=NOON)
    assert sorted(r.failure_reason for r in store.dead_letters().collect()) == [
        "LATE_EVENT", "UNKNOWN_TOPIC"]
    landed = spark.read.schema(S.RAW_ORDERS).parquet(f"{path}/{S.ORDERS_TOPIC}")
    assert {r.order_id for r in landed.collect()} == {"O1", "EDGE"}
    assert intake.accepted(spark, path, S.PAYMENTS_TOPIC).isStreaming


def test_a_landed_folder_stays(spark, tmp_path):
    for n in range(2):
        spark.range(n + 1).write.parquet(str(tmp_path / f"aside{n}"))
        move_folder(spark, str(tmp_path / f"aside{n}"), str(tmp_path / "in" / "batch_id=0"))
    assert spark.read.parquet(str(tmp_path / "in")).count() == 1
    assert not (tmp_path / "aside1").exists()


def test_progress_of_a_stream(spark, tmp_path):
    store = Store(spark, str(tmp_path / "tables"))
    log = progress.ProgressLog(store)
    spark.streams.addListener(log)
    try:
        for n in range(2):
            spark.range(3 + n).select("id", F.lit(NOON.isoformat()).cast("timestamp").alias(
                "event_timestamp")).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema("id bigint, event_timestamp timestamp").parquet(
                str(tmp_path / "in")).observe("seen", F.sum("id").alias("ids"))
            query = streams.deduplicate(stream, ["id"]).writeStream.queryName("ids").format(
                "parquet").option("path", str(tmp_path / "out")).option(
                "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
            query.awaitTermination()
            assert log.wait_for(query)
    finally:
        spark.streams.removeListener(log)
    rows = progress.stream_progress(store).where("input_rows > 0").orderBy("batch_id").collect()
    assert [(r.query_name, r.input_rows, r.observed) for r in rows] == [
        ("ids", 3, '{"seen": {"ids": 3}}'), ("ids", 4, '{"seen": {"ids": 6}}')]
    assert rows[0].state_rows == 3 and len({r.query_id for r in rows}) == 1
