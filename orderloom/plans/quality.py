"""Daily data quality checks. Each gives rows of the check result table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.rates import percent, ratio
from orderloom.functions.times import moment, plus_seconds, within_last_day

# Thresholds and the checked columns.
MIN_ROWS = 10
MAX_NULL_PERCENT = 10
DLQ_WARN_RATIO = 2
DLQ_FAIL_RATIO = 5
TOP_REASONS = 10
MAX_BATCH_MS = 60000
MAX_FAILURE_RATE = 0.05
NULL_CHECKS = {
    "raw_order_events": ("event_type", "event_timestamp", "total_amount"),
    "raw_payment_events": ("payment_id", "order_id"),
    "raw_inventory_events": ("sku", "quantity_delta"),
}


def _row(name: Column, status: Column, expected, actual: Column, details: Column) -> Column:
    expected = F.lit(expected).cast("double")
    return F.struct(name.alias("check_name"), status.alias("status"),
                    expected.alias("expected_value"), actual.cast("double").alias("actual_value"),
                    details.alias("details"))


def _results(aggregate: DataFrame, rows: list[Column], as_of: Column) -> DataFrame:
    """Check rows of a one-row aggregate; rows that do not apply are null and left out."""
    return (aggregate.select(F.explode(F.array_compact(F.array(*rows))).alias("r"))
            .select("r.check_name", F.to_date(as_of).alias("check_date"), "r.status",
                    "r.expected_value", "r.actual_value", "r.details"))


def _when(good: Column, otherwise: str) -> Column:
    return F.when(good, "PASS").otherwise(otherwise)


def _profile(table: DataFrame, columns: tuple[str, ...], as_of: Column) -> DataFrame:
    """Row count and null counts of the last day in one scan."""
    return table.where(within_last_day(F.col("ingested_at"), as_of)).agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def _count_row(name: str) -> Column:
    return _row(F.lit(f"{name}_24h"), _when(F.col("n") >= MIN_ROWS, "FAIL"), MIN_ROWS, F.col("n"),
                F.format_string("%d rows in the last 24 hours", "n"))


def _null_row(name: str, column: str) -> Column:
    nulls = F.col(f"null_{column}")
    rate = F.coalesce(percent(nulls, F.col("n")), F.lit(0)).cast("decimal(10,2)")
    return _row(F.lit(f"null_rate_{name}_{column}"), _when(rate <= MAX_NULL_PERCENT, "FAIL"),
                float(MAX_NULL_PERCENT), rate,
                F.format_string("%d of %d rows null, %s percent", nulls, "n", rate.cast("string")))


def raw_checks(tables: dict[str, DataFrame], as_of=None, counts: bool = True,
               nulls: bool = True) -> DataFrame:
    """Row count and null rate checks of the raw tables, one scan per table."""
    at = moment(as_of)
    parts = []
    for name, columns in NULL_CHECKS.items():
        wanted = columns if nulls else ()
        rows = [_count_row(name)] if counts else []
        rows += [_null_row(name, c) for c in wanted]
        parts.append(_results(_profile(tables[name], wanted, at), rows, at))
    return reduce(DataFrame.unionByName, parts)


def check_row_counts(tables: dict[str, DataFrame], as_of=None) -> DataFrame:
    return raw_checks(tables, as_of, nulls=False)


def check_null_rates(tables: dict[str, DataFrame], as_of=None) -> DataFrame:
    return raw_checks(tables, as_of, counts=False)


def profiled_raw_checks(profiles: DataFrame, as_of=None) -> DataFrame:
    """The same rows from the profiles that batches stored; the raw tables are not read."""
    at = moment(as_of)
    recent = profiles.where(within_last_day(F.col("ingested_at"), at))
    parts = []
    for name, columns in NULL_CHECKS.items():
        own = F.col("table_name") == name
        n = F.coalesce(F.sum(F.when(own & F.col("column_name").isNull(), F.col("n"))), F.lit(0))
        totals = recent.where(own).agg(n.alias("n"), *[
            F.coalesce(F.sum(F.when(F.col("column_name") == c, F.col("n"))), F.lit(0))
            .alias(f"null_{c}") for c in columns])
        parts.append(_results(totals, [_count_row(name), *[_null_row(name, c) for c in columns]], at))
    return reduce(DataFrame.unionByName, parts)


def check_reconciliation_rate(gold: DataFrame, as_of=None) -> DataFrame:
    at = moment(as_of)
    return _reconciliation_rate(gold.where(within_last_day(F.col("reconciled_at"), at)).agg(
        F.count("*").alias("n"), F.count("payment_id").alias("paid")), at)


def summed_reconciliation_rate(clocks: DataFrame, as_of=None) -> DataFrame:
    """The same row from the changes that batches stored (`Store.gold_clocks`)."""
    at = moment(as_of)
    return _reconciliation_rate(clocks.where(within_last_day(F.col("reconciled_at"), at)).agg(
        *[F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(name)
          for c, name in (("orders", "n"), ("paid", "paid"))]), at)


def _reconciliation_rate(totals: DataFrame, at: Column) -> DataFrame:
    rate = F.coalesce(percent(F.col("paid"), F.col("n")), F.lit(0)).cast("decimal(10,2)")
    return _results(totals, [_row(
        F.lit("reconciliation_rate_24h"), _when(rate > 0, "WARN"), None, rate,
        F.format_string("%d of %d orders have a payment, %s percent", "paid", "n",
                        rate.cast("string")))], at)


def check_dlq_growth(dead_letters: DataFrame, as_of=None) -> DataFrame:
    """Today's dead letters against yesterday's; rows with a count `n` stand for so many."""
    at = moment(as_of)
    today = F.date_trunc("day", at)
    failed = F.col("failed_at")
    since = plus_seconds(today, -86400)
    n = _weight(dead_letters)
    counts = dead_letters.where((failed >= since) & (failed <= at)).agg(*[
        F.coalesce(F.sum(F.when(when, n)), F.lit(0).cast("bigint")).alias(name)
        for when, name in ((failed >= today, "today"), (failed < today, "before"))])
    growth = F.coalesce(ratio(F.col("today"), F.col("before"), 2), F.lit(0)).cast("decimal(20,2)")
    status = (F.when(F.col("before") == 0, "PASS")
              .when(F.col("today") > DLQ_FAIL_RATIO * F.col("before"), "FAIL")
              .when(F.col("today") > DLQ_WARN_RATIO * F.col("before"), "WARN").otherwise("PASS"))
    return _results(counts, [_row(
        F.lit("dlq_growth_rate"), status, 1.0, growth,
        F.format_string("%d today, %d the day before", "today", "before"))], at)


def _weight(rows: DataFrame) -> Column:
    return F.col("n") if "n" in rows.columns else F.lit(1).cast("bigint")


def check_dlq_breakdown(dead_letters: DataFrame, as_of=None, top: int = TOP_REASONS) -> DataFrame:
    """The `top` most frequent reasons of the last day in one line; no row when there are none."""
    at = moment(as_of)
    top = (dead_letters.where(within_last_day(F.col("failed_at"), at))
           .groupBy("source_topic", "failure_reason").agg(F.sum(_weight(dead_letters)).alias("n"))
           .orderBy(F.desc("n"), "source_topic", "failure_reason").limit(top))
    entry = F.struct((-F.col("n")).alias("rank"), "source_topic", "failure_reason", F.concat_ws(
        "", "source_topic", F.lit("/"), "failure_reason", F.lit(":"), "n").alias("text"))
    line = top.agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(entry)).alias("entries"))
    return _results(line, [F.when(F.col("n") > 0, _row(
        F.lit("dlq_breakdown_24h"), F.lit("INFO"), None, F.col("n"),
        F.array_join(F.col("entries.text"), ", ")))], at)


def check_pipeline_metrics(metrics: DataFrame, as_of=None) -> DataFrame:
    """Batches ran, were fast enough, and failed rarely; the last two only where known."""
    at = moment(as_of)
    totals = metrics.where(within_last_day(F.col("batch_timestamp"), at)).agg(
        F.count("*").alias("n"),
        ratio(F.sum("processing_duration_ms"), F.count("processing_duration_ms"), 0).alias("ms"),
        F.round(F.sum("reconciliation_failure_rate")
                / F.nullif(F.count("reconciliation_failure_rate"), F.lit(0).cast("bigint"))
                .cast("decimal(20,0)"), 4).alias("rate"),
        F.max("batch_timestamp").alias("last"))
    ms, rate = F.col("ms"), F.col("rate")
    last = F.coalesce(F.date_format("last", "yyyy-MM-dd HH:mm:ss"), F.lit("never"))
    return _results(totals, [
        _row(F.lit("pipeline_batches_24h"), _when(F.col("n") > 0, "WARN"), 1, F.col("n"),
             F.format_string("%d batches in the last 24 hours, last %s", "n", last)),
        F.when(ms != 0, _row(
            F.lit("pipeline_processing_time"), _when(ms < MAX_BATCH_MS, "WARN"), MAX_BATCH_MS, ms,
            F.format_string("average %s ms per batch", ms.cast("bigint").cast("string")))),
        F.when(rate.isNotNull(), _row(
            F.lit("pipeline_failure_rate"), _when(rate < MAX_FAILURE_RATE, "WARN"),
            MAX_FAILURE_RATE, rate,
            F.format_string("average failure rate %s",
                            rate.cast("decimal(10,4)").cast("string")))),
    ], at)


def all_checks(tables: dict[str, DataFrame], gold: DataFrame, dead_letters: DataFrame,
               metrics: DataFrame, as_of=None) -> DataFrame:
    """Every check; each raw table is scanned once."""
    return reduce(DataFrame.unionByName, [
        raw_checks(tables, as_of), check_reconciliation_rate(gold, as_of),
        check_dlq_growth(dead_letters, as_of), check_dlq_breakdown(dead_letters, as_of),
        check_pipeline_metrics(metrics, as_of)])


def stored_checks(profiles: DataFrame, clocks: DataFrame, dead_letter_counts: DataFrame,
                  metrics: DataFrame, as_of=None) -> DataFrame:
    """Every check from what batches stored about themselves: a few rows per batch."""
    return reduce(DataFrame.unionByName, [
        profiled_raw_checks(profiles, as_of), summed_reconciliation_rate(clocks, as_of),
        check_dlq_growth(dead_letter_counts, as_of), check_dlq_breakdown(dead_letter_counts, as_of),
        check_pipeline_metrics(metrics, as_of)])
