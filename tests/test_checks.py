import pytest
from helpers import AS_OF
from pyspark.sql import functions as F

from orderloom.plans import quality as Q


def raw(spark, n, nulls=0, age_hours=1):
    at = F.lit(AS_OF).cast("timestamp") - F.make_dt_interval(hours=F.lit(age_hours))
    value = F.when(F.col("id") >= nulls, "v")
    names = ("event_type", "event_timestamp", "total_amount", "payment_id", "order_id", "sku",
             "quantity_delta")
    return spark.range(n).select(at.alias("ingested_at"), *[value.alias(c) for c in names])


def tables(spark, **kw):
    return {name: raw(spark, **kw) for name in Q.NULL_CHECKS}


def results(df):
    return {r.check_name: r for r in df.collect()}


@pytest.mark.parametrize("n,status", [(9, "FAIL"), (10, "PASS")])
def test_row_counts(spark, n, status):
    out = results(Q.check_row_counts(tables(spark, n=n), AS_OF))
    assert {r.status for r in out.values()} == {status} and len(out) == 3
    assert out["raw_order_events_24h"].actual_value == n


def test_old_rows_do_not_count(spark):
    out = results(Q.check_row_counts(tables(spark, n=50, age_hours=25), AS_OF))
    assert {r.actual_value for r in out.values()} == {0.0}


@pytest.mark.parametrize("n,nulls,status,rate", [
    (100, 10, "PASS", 10.0), (100, 11, "FAIL", 11.0), (0, 0, "PASS", 0.0), (3, 1, "FAIL", 33.33)])
def test_null_rates(spark, n, nulls, status, rate):
    out = results(Q.check_null_rates(tables(spark, n=n, nulls=nulls), AS_OF))
    assert len(out) == 7
    assert {(r.status, r.actual_value) for r in out.values()} == {(status, rate)}


@pytest.mark.parametrize("today,before,status,ratio", [
    (5, 0, "PASS", 0.0), (2, 1, "PASS", 2.0), (3, 1, "WARN", 3.0), (5, 1, "WARN", 5.0),
    (6, 1, "FAIL", 6.0), (0, 0, "PASS", 0.0)])
def test_dlq_growth(spark, today, before, status, ratio):
    failed = [("2024-01-15 01:00:00",)] * today + [("2024-01-14 23:59:59",)] * before + [
        ("2024-01-13 23:00:00",), ("2024-01-15 13:00:00",)]
    dead = spark.createDataFrame(failed, "t string").select(
        F.col("t").cast("timestamp").alias("failed_at"))
    row = Q.check_dlq_growth(dead, AS_OF).first()
    assert (row.status, row.actual_value) == (status, ratio)


def test_dlq_breakdown_lists_the_top_ten(spark):
    data = [("t", f"R{n:02d}") for n in range(12) for _ in range(12 - n)]
    dead = spark.createDataFrame(data, "source_topic string, failure_reason string").withColumn(
        "failed_at", F.lit(AS_OF).cast("timestamp"))
    row = Q.check_dlq_breakdown(dead, AS_OF).first()
    assert row.details.startswith("t/R00:12, t/R01:11") and row.details.count(",") == 9
    assert row.actual_value == sum(range(3, 13)) and row.status == "INFO"
    assert Q.check_dlq_breakdown(dead, "2030-01-01").count() == 0


def metrics(spark, *rows):
    return spark.createDataFrame(rows, "t string, processing_duration_ms bigint, r string").select(
        F.col("t").cast("timestamp").alias("batch_timestamp"), "processing_duration_ms",
        F.col("r").cast("decimal(6,4)").alias("reconciliation_failure_rate"))


def test_pipeline_metrics(spark):
    slow = results(Q.check_pipeline_metrics(metrics(
        spark, ("2024-01-15 11:00:00", 60000, "0.0500"), ("2024-01-15 10:00:00", 59999, "0.0499")),
        AS_OF))
    assert slow["pipeline_processing_time"].status == "WARN"  # 59999.5 rounds up
    assert slow["pipeline_failure_rate"].actual_value == 0.05
    assert slow["pipeline_failure_rate"].status == "WARN"
    quiet = results(Q.check_pipeline_metrics(metrics(
        spark, ("2024-01-01 11:00:00", 1, "0.0")), AS_OF))
    assert {n: r.status for n, r in quiet.items()} == {"pipeline_batches_24h": "WARN"}
    unknown = results(Q.check_pipeline_metrics(metrics(
        spark, ("2024-01-15 11:00:00", 0, None)), AS_OF))
    assert set(unknown) == {"pipeline_batches_24h"}


def test_reconciliation_rate(spark):
    gold = spark.createDataFrame([("P",), (None,), (None,)], "payment_id string").withColumn(
        "reconciled_at", F.lit(AS_OF).cast("timestamp"))
    assert Q.check_reconciliation_rate(gold, AS_OF).first().actual_value == 33.33
    empty = Q.check_reconciliation_rate(gold.limit(0), AS_OF).first()
    assert (empty.status, empty.actual_value) == ("WARN", 0.0)
