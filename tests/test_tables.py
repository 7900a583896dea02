from datetime import date, datetime
from decimal import Decimal
from types import SimpleNamespace

import pytest
from helpers import AS_OF
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.operators.keyed import first_wins, last_wins, resolve_versions
from orderloom.plans.summary import hourly_sla_summary
from orderloom.session import work_dir
from orderloom.sinks.tables import (Store, any_of, now_counts, overwrite_days, read_table,
                                    write_checks)
from orderloom.sources.archive import archive, replay

FIELDS = ("order_id string, event_type string, ts string, customer_id string, "
          "total_amount double, currency string, status string, source_offset bigint")


def events(spark, *data):
    full = [(o, "ORDER_CREATED", ts, "C1", amount, "USD", "new", n) for o, ts, amount, n in data]
    return (spark.createDataFrame(full, FIELDS)
            .withColumn("event_timestamp", F.col("ts").cast("timestamp")).drop("ts"))


def stored(store):
    return {(r.order_id, float(r.total_amount), r.batch_id)
            for r in store.raw(S.ORDERS_TOPIC).collect()}


def test_first_row_of_a_key_stays(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    day1, day2 = "2024-01-14 10:00:00", "2024-01-15 10:00:00"
    store.add_raw(events(spark, ("A", day1, 1.0, 0), ("A", day1, 2.0, 1), ("B", day2, 0.0, 2)),
                  S.ORDERS_TOPIC, 0)
    second = events(spark, ("A", day1, 9.0, 3), ("A", day2, 3.0, 4), ("B", day2, 9.0, 5))
    for _ in range(2):  # a retry changes nothing
        store.add_raw(second, S.ORDERS_TOPIC, 1)
        assert stored(store) == {("A", 1.0, 0), ("B", 0.0, 0), ("A", 3.0, 1)}
    days = [date(2024, 1, 14), date(2024, 1, 15)]
    store.add_raw(second, S.ORDERS_TOPIC, 2, dates=days)
    assert len(stored(store)) == 3
    assert {r.order_id for r in store.raw_of(S.ORDERS_TOPIC, days[1:], 0).collect()} == {"B"}
    assert store.raw_of(S.ORDERS_TOPIC, []).count() == 0
    assert store.raw(S.ORDERS_TOPIC, ingested_since="2100-01-01").count() == 0
    assert store.raw(S.ORDERS_TOPIC, ingested_since="2020-01-01").count() == 3


def test_rows_without_full_key_are_left_out(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.add_raw(events(spark, ("A", None, 1.0, 0), (None, "2024-01-14", 1.0, 1)),
                  S.ORDERS_TOPIC, 0)
    assert stored(store) == set()


def test_missing_table_reads_as_empty(spark, tmp_path):
    assert Store(spark, str(tmp_path)).gold().count() == 0


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z")], "k string, n int, v string")
    assert {tuple(r) for r in first_wins(df, ["k"], ["n"]).collect()} == {("a", 1, "x"), ("b", 5, "z")}
    assert {tuple(r) for r in last_wins(df, ["k"], ["n"]).collect()} == {("a", 2, "y"), ("b", 5, "z")}


def test_mixed_rule_keeps_nulls_of_the_last_version(spark):
    df = spark.createDataFrame([("a", 0, "first", "p"), ("a", 1, "later", None)],
                               "k string, version int, kept string, moved string")
    row = resolve_versions(df, ["k"], ["kept"], "version").first()
    assert (row.kept, row.moved) == ("first", None)


def gold_row(spark, order_id, ts, customer, payment):
    names = [c.split()[0] for c in S.GOLD.split(", ")]
    values = {"order_id": order_id, "event_timestamp": ts, "customer_id": customer,
              "payment_id": payment, "payment_sla_met": payment is not None,
              "inventory_sla_met": False}
    row = spark.range(1).select(*[
        F.lit(values.get(c.split()[0])).cast(c.split()[1]).alias(c.split()[0])
        for c in S.GOLD.split(", ")])
    assert row.columns == names
    return row


def test_gold_upsert_retry_and_compaction(spark, tmp_path):
    store = Store(spark, str(tmp_path / "a"))
    ts = "2024-01-14 10:00:00"
    store.add_gold(gold_row(spark, "A", ts, "C1", None), 0)
    for _ in range(2):
        store.add_gold(gold_row(spark, "A", ts, "C2", "P1"), 1)
    row = store.gold().collect()
    assert [(r.customer_id, r.payment_id) for r in row] == [("C1", "P1")]
    store.compact_gold(str(tmp_path / "scratch"))
    assert store.gold_versions().count() == 1
    assert [(r.customer_id, r.payment_id) for r in store.gold().collect()] == [("C1", "P1")]
    store.add_gold(gold_row(spark, "A", ts, "C3", None), 2)
    assert [(r.customer_id, r.payment_id) for r in store.gold().collect()] == [("C1", None)]


def partition_filters(df):
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.partitionFilters().mkString(), leaf.relation().location().rootPaths().size()


def test_readers_list_only_their_dates(spark, tmp_path):
    """Batches outside the range add no folder to what is listed."""
    store = Store(spark, str(tmp_path))
    seen = set()
    for batch in range(6):
        store.add_gold(gold_row(spark, f"O{batch}", f"2024-01-{10 + batch} 10:00:00", "C", None), batch)
        rows = store.gold(datetime(2024, 1, 9), datetime(2024, 1, 11))
        versions = store.gold_versions(datetime(2024, 1, 9), datetime(2024, 1, 11))
        seen.add((rows.count(), len(versions.inputFiles()), partition_filters(versions)[1]))
    assert seen == {(1, 1, 1)}
    open_end = store.gold_versions(since="2024-01-13 12:00:00")
    assert "event_date" in partition_filters(open_end)[0]
    assert {r.order_id for r in open_end.collect()} == {"O4", "O5"}
    assert store.gold(datetime(2023, 1, 1), datetime(2023, 2, 1)).count() == 0


def test_many_batch_folders(spark, tmp_path):
    """500 batches of other days: the listed folder is still the one of the day."""
    store = Store(spark, str(tmp_path))
    rows = spark.range(500).select(
        F.concat(F.lit("O"), "id").alias("order_id"),
        (F.lit("2020-01-01").cast("timestamp") + F.make_dt_interval(F.col("id").cast("int"))).alias(
            "event_timestamp"), F.col("id").alias("batch_id"))
    (rows.withColumn("event_date", F.to_date("event_timestamp")).repartition(4).write.partitionBy(
        "event_date", "batch_id").parquet(store.path("reconciled_order_events")))
    day = store.gold_versions(datetime(2020, 3, 1), datetime(2020, 3, 1, 23))
    assert (day.count(), len(day.inputFiles()), partition_filters(day)[1]) == (1, 1, 1)


def test_partitions(spark):
    assert any_of("d", [date(2024, 1, 2), date(2024, 1, 1)]) == "d={2024-01-01,2024-01-02}"
    low, high = datetime(2023, 12, 31, 23), datetime(2024, 2, 1)
    month = Store(spark, "unused", "month").partitions_between(low, high)
    assert month == [date(2023, 12, 1), date(2024, 1, 1), date(2024, 2, 1)]
    assert Store(spark, "unused", "year").partitions_between(low, high) == [
        date(2023, 1, 1), date(2024, 1, 1)]
    assert len(Store(spark, "unused").partitions_between(low, high)) == 33


@pytest.mark.parametrize("grain,expected", [
    ("day", "2024-01-31"), ("month", "2024-01-01"), ("year", "2024-01-01")])
def test_grain(spark, grain, expected):
    store = Store(spark, "unused", grain)
    row = spark.range(1).select(
        store.partition_of(F.lit("2024-01-31 23:59:59").cast("timestamp")).alias("p"),
    ).select(F.col("p"), store.next_partition(F.col("p")).alias("n")).first()
    following = {"day": "2024-02-01", "month": "2024-02-01", "year": "2025-01-01"}[grain]
    assert (str(row.p), str(row.n)) == (expected, following)


def test_archive_prunes_folders_and_survives_a_retry(spark, tmp_path):
    path = str(tmp_path)
    df = spark.sql("SELECT id, timestamp'2024-01-31 22:30:00' + make_dt_interval(0,0,0,id*1800) "
                   "AS event_timestamp FROM range(8)")
    for _ in range(2):
        archive(df, path, 0)
    schema = "id bigint, event_timestamp timestamp"
    out = replay(spark, path, schema, "2024-01-31 23:30:00", "2024-02-01 00:30:00")
    assert sorted(r.id for r in out.collect()) == [2, 3]
    scan = out._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert "make_timestamp(year" in scan.partitionFilters().mkString()
    assert replay(spark, path, schema, "2024-01-31", "2024-03-01").count() == 8
    archive(df.withColumn("event_timestamp", F.lit(None).cast("timestamp")).limit(2), path, 1)
    assert replay(spark, path, schema, "2024-01-31", "2024-03-01").count() == 8
    assert read_table(spark, path, schema, "year int, month int, day int, hour int").count() == 10


def test_summary_days_are_replaced(spark, tmp_path):
    gold = spark.sql("SELECT timestamp'2024-01-14 10:10:00' AS event_timestamp, true AS "
                     "payment_sla_met, false AS inventory_sla_met")
    for df in (gold, gold.union(gold), gold.union(gold)):
        overwrite_days(hourly_sla_summary(df, AS_OF), str(tmp_path))
    rows = spark.read.parquet(str(tmp_path)).collect()
    assert [(r.hour, r.total_orders, r.payment_sla_rate, r.inventory_sla_rate) for r in rows] == [
        (10, 2, Decimal("100.00"), Decimal("0.00"))]


def test_metrics_rate(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for batch, (n, bad) in enumerate([(3, 1), (0, 0)]):
        store.add_metrics(now_counts(spark, batch, AS_OF, input_rows=n, reconciled_rows=0,
                                     dlq_rows=bad, processing_duration_ms=5), batch)
    rates = {r.batch_id: r.reconciliation_failure_rate for r in store.metrics().collect()}
    assert rates == {0: Decimal("0.3333"), 1: Decimal("0.0000")}


def test_work_dir_follows_the_session(tmp_path):
    def session(**settings):
        get = SimpleNamespace(get=lambda name, default=None: settings.get(name, default))
        return SimpleNamespace(conf=get, sparkContext=SimpleNamespace(getConf=lambda: get))

    shared = session(**{"spark.checkpoint.dir": "hdfs://x/y/", "spark.sql.warehouse.dir": "w"})
    assert work_dir(shared, "x").startswith("hdfs://x/y/x-")
    assert work_dir(session(**{"spark.sql.warehouse.dir": "s3a://w"}), "x").startswith("s3a://w/_work/x-")


def test_checks_of_a_run_are_replaced(spark, tmp_path):
    row = spark.range(1).select(*[F.lit(None).cast(c.split()[1]).alias(c.split()[0])
                                  for c in S.CHECK_RESULTS.split(", ")])
    for run in ("a", "a", "b"):
        write_checks(row, str(tmp_path), run)
    assert spark.read.schema(S.CHECK_RESULTS).parquet(str(tmp_path)).count() == 2
    assert read_table(spark, str(tmp_path / "none"), S.CHECK_RESULTS).count() == 0


def test_rows_of_few_dates_are_neither_cached_nor_gathered(spark, tmp_path, monkeypatch):
    from orderloom.sinks import tables
    hints, kind = [], type(spark.range(1))
    gather = kind.hint
    monkeypatch.setattr(kind, "hint", lambda self, *a: hints.append(a) or gather(self, *a))
    monkeypatch.setattr(kind, "persist", lambda *a: pytest.fail("rows are cached"))
    monkeypatch.setattr(tables, "work_dir", lambda spark, label: str(tmp_path / label))
    store = Store(spark, str(tmp_path / "store"))
    few = [("A", f"2024-01-{n:02} 10:00:00", 1.0, n) for n in range(1, 3)]
    for batch in (0, 1, 1):
        store.add_raw(events(spark, *few), S.ORDERS_TOPIC, batch)
    assert hints == [] and store.raw(S.ORDERS_TOPIC).count() == 2 and not (tmp_path / "rows").exists()
    many = [("B", f"2024-01-{n:02} 10:00:00", 1.0, n) for n in range(1, 21)]
    store.add_raw(events(spark, *many), S.ORDERS_TOPIC, 2)
    assert hints == [("rebalance", "event_date")] and store.raw(S.ORDERS_TOPIC).count() == 22
