"""The daily jobs over a store: checks and summaries, each repeatable for a day.

They read what batches stored about themselves (profiles, changes of sums, counts of dead letters,
metrics), a few rows per batch, and of these only the folders of their days. Neither raw events nor
gold nor dead letters are scanned.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame

from orderloom import schemas as S
from orderloom.functions.times import utc
from orderloom.plans import quality, summary
from orderloom.sinks.tables import Store, overwrite_days, write_checks

DAY = timedelta(days=1)
INSTANT = timedelta(microseconds=1)


def run_checks(store: Store, path: str, as_of: datetime) -> DataFrame:
    """All checks as of a time, written as the run of that time; a second run replaces the first."""
    as_of = utc(as_of)
    since, upto = as_of - DAY, as_of + INSTANT
    rows = quality.stored_checks(
        store.raw_profiles(since, upto), store.gold_clocks(since, upto),
        store.dead_letter_counts(_midnight(as_of) - DAY, upto), store.metrics(since, upto), as_of)
    run_id = as_of.strftime("%Y%m%dT%H%M%S")
    write_checks(rows, path, run_id)
    return store.spark.read.schema(S.CHECK_RESULTS).parquet(f"{path}/run_id={run_id}")


def run_summaries(store: Store, root: str, as_of: datetime) -> None:
    """Hourly SLA rows and daily dead letter rows of the day before, replacing earlier ones."""
    today = _midnight(utc(as_of))
    overwrite_days(summary.hourly_sla_of(store.gold_hours(today - DAY, today)),
                   f"{root}/hourly_sla_summary")
    overwrite_days(summary.dlq_daily_summary(store.dead_letter_counts(today - DAY, today), as_of),
                   f"{root}/dlq_daily_summary")


def _midnight(time: datetime) -> datetime:
    return time.replace(hour=0, minute=0, second=0, microsecond=0)
