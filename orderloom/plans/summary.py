"""Daily summaries, counts, and the lookups the tables are laid out for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.rates import percent
from orderloom.functions.times import moment, on_previous_day


def hourly_sla(gold: DataFrame) -> DataFrame:
    """Orders per day and hour with how many met each limit."""
    day, hour = F.to_date("event_timestamp"), F.hour("event_timestamp")
    return _with_rates(gold.groupBy(day.alias("summary_date"), hour.alias("hour")).agg(
        F.count("*").alias("total_orders"), F.count_if("payment_sla_met").alias("payment_sla_met"),
        F.count_if("inventory_sla_met").alias("inventory_sla_met")))


def hourly_sla_of(changes: DataFrame) -> DataFrame:
    """The same rows from the changes that batches stored (`Store.gold_hours`)."""
    return _with_rates(changes.groupBy("summary_date", "hour").agg(*[
        F.sum(c).alias(c) for c in ("total_orders", "payment_sla_met", "inventory_sla_met")]).where(
        "total_orders > 0"))


def _with_rates(hours: DataFrame) -> DataFrame:
    return (hours.select("summary_date", "hour", "total_orders", "payment_sla_met",
                    percent(F.col("payment_sla_met"), F.col("total_orders"))
                    .alias("payment_sla_rate"),
                    "inventory_sla_met",
                    percent(F.col("inventory_sla_met"), F.col("total_orders"))
                    .alias("inventory_sla_rate")))


def hourly_sla_summary(gold: DataFrame, as_of=None) -> DataFrame:
    """Hourly rows of the day before `as_of`."""
    return hourly_sla(gold.where(on_previous_day(F.col("event_timestamp"), moment(as_of))))


def dlq_daily(dead_letters: DataFrame) -> DataFrame:
    """Dead letters per day, topic and reason; rows with a count `n` stand for so many."""
    n = F.sum("n") if "n" in dead_letters.columns else F.count("*")
    return (dead_letters.groupBy(F.to_date("failed_at").alias("summary_date"), "source_topic",
                                 "failure_reason").agg(n.alias("event_count")))


def dlq_daily_summary(dead_letters: DataFrame, as_of=None) -> DataFrame:
    """Dead letters of the day before `as_of` by topic and reason."""
    return dlq_daily(dead_letters.where(on_previous_day(F.col("failed_at"), moment(as_of))))


def topic_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy("topic").agg(F.count("*").alias("n"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()])


def orders_for_customer(gold: DataFrame, customer_id: str) -> DataFrame:
    return gold.where(F.col("customer_id") == customer_id).orderBy(F.desc("event_timestamp"),
                                                                   "order_id")


def recent_orders(gold: DataFrame, since) -> DataFrame:
    return gold.where(F.col("event_timestamp") >= moment(since)).orderBy(
        F.desc("event_timestamp"), "order_id")


def sla_misses(gold: DataFrame, since=None) -> DataFrame:
    """Orders that missed a limit, newest first."""
    rows = gold.where(~F.col("payment_sla_met") | ~F.col("inventory_sla_met"))
    if since is not None:
        rows = rows.where(F.col("event_timestamp") >= moment(since))
    return rows.orderBy(F.desc("event_timestamp"), "order_id")


def dlq_by_topic(dead_letters: DataFrame, topic: str) -> DataFrame:
    return dead_letters.where(F.col("source_topic") == topic).orderBy(F.desc("failed_at"),
                                                                      "failure_reason")
