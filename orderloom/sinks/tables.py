"""Keyed and append-only Parquet tables written one batch at a time.

A dated table is a folder of `event_date=D/batch_id=N` folders (raw events have the day of arrival in
between), the date outermost: readers that know their dates name these folders and list no others,
however many batches there are. A batch replaces its own folders when it is run again, and a batch
run again has the same rows (see `streaming.job`), so each write can be repeated after a failure
without leaving duplicates. On a table format with MERGE the version log of gold would become a
MERGE; plain Parquet has none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.functions.rates import ratio
from orderloom.functions.times import moment, utc
from orderloom.operators.keyed import (event_columns, first_wins, only_new, raw_columns,
                                      resolve_gold, with_full_key)
from orderloom.session import release, table_at, work_dir

#: So many partition values are written by every task as its rows lie, without gathering each value's.
FEW_FOLDERS = 16
#: Of all tables: what is stored is mostly text, and disk is what large batches run short of.
COMPRESSION = "zstd"


def read_table(spark: SparkSession, path: str, schema: str, partitions: str = "",
               within: str = "") -> DataFrame:
    """All batches of a table with their `batch_id`; no rows when nothing was written yet.

    `within` is a pattern of folders below `path`; only these are listed.
    """
    full = ", ".join(x for x in (schema, partitions, "batch_id bigint") if x)
    try:
        return spark.read.schema(full).option("basePath", path).parquet(f"{path}/{within}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def write_batch(rows: DataFrame, path: str, batch_id: int, partitions: Sequence[str] = (),
                totals: dict[str, Column] | None = None,
                finish: Callable[[DataFrame], DataFrame] | None = None,
                folders: int | None = None) -> dict[str, int]:
    """Write one batch, replacing an earlier attempt; returns `totals` (sums and counts) of its rows.

    The rebalance hint gathers each partition value in few files and lets AQE split a value that
    holds a large share of the rows. Totals are observed in the tasks that write, whose results count
    once, also when tasks before them are done again for a lost executor. `finish` makes the stored
    columns in these tasks, so that what can be made from others is not shuffled; partitions that
    it makes should be few. `folders` is the number of partition values, if known: rows of a few need no
    gathering, since every task has a file for each of them at most, and are not shuffled for it.
    """
    if not partitions:
        rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(
            f"{path}/batch_id={batch_id}")
        return {}
    gathered = rows
    if folders is None or folders > FEW_FOLDERS:
        gathered = rows.hint("rebalance", *[c for c in partitions if c in rows.columns])
    balanced = (finish(gathered) if finish else gathered).withColumn(
        "batch_id", F.lit(batch_id).cast("bigint"))
    seen = Observation()
    if totals:
        balanced = balanced.observe(seen, *[c.alias(name) for name, c in totals.items()])
    (balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", COMPRESSION).partitionBy(*partitions, "batch_id").parquet(path))
    return _observed(seen, totals) if totals else {}


def _observed(seen: Observation, totals: dict[str, Column]) -> dict[str, int]:
    try:
        return dict(seen.get)
    except Py4JJavaError as error:
        if "toPyRow" not in str(error):
            raise
        return dict.fromkeys(totals, 0)  # a plan found to be empty has nothing left to observe


def bloom_filters(*columns: str) -> dict[str, str]:
    """Write options for Parquet Bloom filters of these columns, each sized by what its row group holds."""
    return {"parquet.bloom.filter.adaptive.enabled": "true", **{
        f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}}


def any_of(column: str, values: Iterable[date]) -> str:
    """Pattern of the folders of these values; of none, a pattern that fits nothing."""
    found = sorted({str(v) for v in values})
    return f"{column}={{{','.join(found) or 'none'}}}"


def partition_values(rows: DataFrame, column: str) -> set[date]:
    """Different partitions of the rows: as many as there will be folders."""
    return {r[0] for r in rows.select(column).distinct().collect() if r[0] is not None}


@dataclass(frozen=True)
class Store:
    """The tables of one pipeline below one folder.

    `grain` is the width of a time partition: day suits a live stream, month or year a backfill
    whose batches span many years with few rows per day. `event_date` is the partition's first day.
    """

    spark: SparkSession
    root: str
    grain: str = "day"

    def partition_of(self, time: Column) -> Column:
        return F.to_date(F.date_trunc(self.grain, time))

    def next_partition(self, partition: Column) -> Column:
        return F.to_date(F.timestamp_add(self.grain.upper(), F.lit(1), partition.cast("timestamp")))

    def partitions_between(self, since: datetime, until: datetime) -> list[date]:
        """First days of all partitions that hold times from `since` up to `until`."""
        since, until = utc(since), utc(until)
        first = {"day": since.date(), "month": since.date().replace(day=1),
                 "year": since.date().replace(month=1, day=1)}[self.grain]
        step = {"day": 1, "month": 31, "year": 366}[self.grain]
        found = []
        while first <= until.date():
            found.append(first)
            first += timedelta(days=step)
            first = {"day": first, "month": first.replace(day=1),
                     "year": first.replace(month=1, day=1)}[self.grain]
        return found

    def partitions_around(self, dates: Iterable[date], before: int = 0, after: int = 0) -> set[date]:
        """The partitions, with the one before each and the one after if wanted."""
        found = set(dates)
        for d in set(found):
            start = datetime.combine(d, datetime.min.time())
            step = timedelta(days={"day": 1, "month": 31, "year": 366}[self.grain])
            found |= set(self.partitions_between(start - timedelta(seconds=before),
                                                 start + step * after)[:2 + before])
        return found

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _dated(self, name: str, schema: str, column: str, time: str, since, until,
               between: str = "") -> DataFrame:
        """Rows with since <= time < until; with both limits given as times or text, only the
        folders of their dates are listed, else the limits prune what is read."""
        kinds = f"{column} date{between}"
        if all(limit is not None and not isinstance(limit, Column) for limit in (since, until)):
            dates = self.partitions_between(since, utc(until) - timedelta(microseconds=1))
            rows = read_table(self.spark, self.path(name), schema, kinds, any_of(column, dates))
        else:
            rows = read_table(self.spark, self.path(name), schema, kinds)
            for limit, keep in ((since, F.col(column).__ge__), (until, F.col(column).__le__)):
                if limit is not None:
                    rows = rows.where(keep(self.partition_of(moment(limit))))
        if since is not None:
            rows = rows.where(F.expr(time) >= moment(since))
        return rows if until is None else rows.where(F.expr(time) < moment(until))

    # Raw events: the first row of a key stays.

    def raw(self, topic: str, since=None, until=None, ingested_since=None) -> DataFrame:
        """Stored events by event time; `ingested_since` looks only at days of arrival from then."""
        rows = self._dated(S.TOPICS[topic].raw_table, S.RAW_TABLES[topic], "event_date",
                           "event_timestamp", since, until, ", ingested_date date")
        if ingested_since is not None:
            at = moment(ingested_since)
            rows = rows.where(F.col("ingested_date") >= F.to_date(at)).where(
                F.col("ingested_at") >= at)
        return rows.drop("ingested_date")

    def raw_of(self, topic: str, dates: Iterable[date], batch_id: int | None = None) -> DataFrame:
        """Stored events of these partitions, or of one batch in them."""
        folders = any_of("event_date", dates)
        if batch_id is not None:
            folders += f"/ingested_date=*/batch_id={batch_id}"
        return read_table(self.spark, self.path(S.TOPICS[topic].raw_table), S.RAW_TABLES[topic],
                          "event_date date, ingested_date date", folders).drop("ingested_date")

    def add_raw(self, events: DataFrame, topic: str, batch_id: int, as_of=None,
                dates: Iterable[date] | None = None) -> dict[str, int]:
        """Store normalised events of a batch, except those whose key is stored already.

        The event time is part of the key, so only stored rows of the batch's own time partitions
        can conflict, and only those are read. Unless given, they are looked up, and the rows are
        a scratch table meanwhile, so that they are computed once and what made them does not take up
        disk while they are ranked and written. Rows travel as events; their text is made in
        the tasks that write, so among copies with one offset the first by their columns stays.
        Returns the number of rows stored and of nulls by column, observed while writing.
        """
        spec = S.TOPICS[topic]
        names = event_columns(events)
        rest = [c for c in names if c not in spec.raw_key]
        dates = None if dates is None else set(dates)
        carried = [c for c in ("source_offset",) if c in events.columns]
        date = self.partition_of(F.col("event_timestamp")).alias("event_date")
        own_clock = [as_of.alias("_at")] if isinstance(as_of, Column) else []
        rows = with_full_key(events, topic).select(
            *spec.raw_key, F.struct(*rest).alias("_rest"), *carried, *own_clock)
        event = {c: F.col(f"_rest.`{c}`" if c in rest else c) for c in names}

        def finish(chosen: DataFrame) -> DataFrame:
            at = F.col("_at") if own_clock else as_of
            return chosen.select(*raw_columns(event, topic, at), "event_date").withColumn(
                "ingested_date", F.to_date("ingested_at"))

        scratch = work_dir(self.spark, "rows") if dates is None else None
        try:
            if scratch:
                rows = table_at(rows, scratch)
                dates = partition_values(rows.select(date), "event_date")
            fresh = first_wins(rows, spec.raw_key, [*carried, "_rest"]).drop(*carried)
            if batch_id:
                earlier = self.raw_of(topic, dates).where(F.col("batch_id") < batch_id)
                fresh = only_new(fresh, earlier, spec.raw_key)
            return write_batch(
                fresh.select("*", date), self.path(spec.raw_table), batch_id,
                ["event_date", "ingested_date"], {"rows": F.count("*"), **{
                    c: F.count_if(F.col(c).isNull()) for c in S.RAW_COLUMNS[topic]}}, finish,
                len(dates))
        finally:
            if scratch:
                remove_folder(self.spark, scratch)
            release(self.spark)

    # Profiles: what daily jobs need to know of the rows that a batch stored, a few rows each.

    def raw_profiles(self, since=None, until=None) -> DataFrame:
        """Per raw table and batch the rows stored, and per column the nulls among them."""
        return self._dated("raw_profiles", S.RAW_PROFILES, "ingested_date", "ingested_at", since, until)

    def add_raw_profiles(self, found: dict[str, dict[str, int]], batch_id: int, as_of=None) -> None:
        """`found` are the numbers that `add_raw` returned, by topic."""
        entries = [F.struct(F.lit(S.TOPICS[topic].raw_table).alias("table_name"),
                            F.lit(None if name == "rows" else name).cast("string").alias("column_name"),
                            F.lit(n).cast("bigint").alias("n"))
                   for topic, own in found.items() for name, n in own.items()]
        rows = self.spark.range(1, numPartitions=1).select(F.inline(F.array(*entries))).withColumn(
            "ingested_at", moment(as_of))
        write_batch(rows.withColumn("ingested_date", self.partition_of(F.col("ingested_at"))),
                    self.path("raw_profiles"), batch_id, ["ingested_date"])

    def dead_letter_counts(self, since=None, until=None) -> DataFrame:
        """Dead letters per batch, topic and reason."""
        return self._dated("dead_letter_counts", S.DEAD_LETTER_COUNTS, "failed_date", "failed_at",
                           since, until)

    def add_dead_letter_counts(self, batch_id: int, clock=None) -> None:
        """Counts what the batch has put into the dead letter table."""
        counts = self.dead_letters_of(batch_id, clock).groupBy(
            "failed_date", "failed_at", "source_topic", "failure_reason").agg(F.count("*").alias("n"))
        write_batch(counts, self.path("dead_letter_counts"), batch_id, ["failed_date"])

    # Dead letters: every row stays.

    def dead_letters(self, since=None, until=None) -> DataFrame:
        return self._dated("dead_letter_events", S.DEAD_LETTERS, "failed_date", "failed_at", since,
                           until)

    def dead_letters_of(self, batch_id: int, clock=None) -> DataFrame:
        """The dead letters of one batch: all of it failed at its clock, so one folder is looked at.
        Without the clock, that of the batch in any date."""
        date = "failed_date=*" if clock is None or isinstance(clock, Column) else any_of(
            "failed_date", self.partitions_between(clock, clock))
        return read_table(self.spark, self.path("dead_letter_events"), S.DEAD_LETTERS,
                          "failed_date date", f"{date}/batch_id={batch_id}")

    def add_dead_letters(self, rows: DataFrame, batch_id: int) -> None:
        dated = rows.withColumn("failed_date", self.partition_of(F.col("failed_at")))
        write_batch(dated, self.path("dead_letter_events"), batch_id, ["failed_date"])

    # Gold: a log of versions, resolved by the mixed conflict rule when read.

    def gold_versions(self, since=None, until=None) -> DataFrame:
        return self._dated("reconciled_order_events", S.GOLD, "event_date", "event_timestamp",
                           since, until)

    def gold_of(self, dates: Iterable[date], batch_id: int | None = None) -> DataFrame:
        """Versions in these partitions, or of one batch in them."""
        folders = any_of("event_date", dates)
        if batch_id is not None:
            folders += f"/batch_id={batch_id}"
        return read_table(self.spark, self.path("reconciled_order_events"), S.GOLD,
                          "event_date date", folders)

    def gold(self, since=None, until=None) -> DataFrame:
        """One row per order event. The time is part of the key, so limits apply before the
        versions are resolved."""
        return resolve_gold(self.gold_versions(since, until).drop("event_date"))

    def add_gold(self, rows: DataFrame, batch_id: int,
                 dates: Iterable[date] | None = None) -> dict[str, int]:
        """Adds versions; returns the number of rows and of those that missed a limit, observed while
        writing. `dates` are the partitions that the rows can lie in, if known."""
        typed = rows.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in S.GOLD.split(", ")])
        dated = typed.withColumn("event_date", self.partition_of(F.col("event_timestamp")))
        try:
            return write_batch(dated, self.path("reconciled_order_events"), batch_id, ["event_date"], {
                "rows": F.count("*"),
                "late": F.count_if(~F.col("payment_sla_met") | ~F.col("inventory_sla_met"))},
                folders=None if dates is None else len(set(dates)))
        finally:
            release(self.spark)

    # Deltas: sums over gold as a log of changes, so that none of them needs the resolved table.

    def add_gold_deltas(self, batch_id: int, dates: Iterable[date] | None = None) -> None:
        """Stores by how much a batch has changed the sums over gold: its versions count, and those
        they take the place of count negative.

        A batch adds one row per hour of its orders and clock of the versions replaced. `dates` are the
        partitions in which the batch has gold rows. A batch run again gives the same rows, as it looks
        at earlier batches only.
        """
        versions = self.gold_versions() if dates is None else self.gold_of(dates)
        facts = F.struct("batch_id", F.col("payment_id").isNotNull().alias("paid"), "payment_sla_met",
                         "inventory_sla_met", "reconciled_at").alias("v")
        key = [*S.GOLD_KEY, "event_date"]
        own = versions.where(F.col("batch_id") == batch_id).select(*key, facts)
        # The folder of the batch is small next to those of its dates, and the log is read once.
        replaced = versions.where(F.col("batch_id") < batch_id).select(*key, facts).join(
            own.select(*key), key, "left_semi").groupBy(*key).agg(F.max("v").alias("v"))
        signed = own.withColumn("sign", F.lit(1)).unionByName(replaced.withColumn("sign", F.lit(-1)))
        n = F.col("sign").cast("bigint")
        sums = signed.groupBy(
            "event_date", F.to_date("event_timestamp").alias("summary_date"),
            F.hour("event_timestamp").alias("hour"), "v.reconciled_at").agg(
            F.sum(n).alias("total_orders"),
            *[F.coalesce(F.sum(F.when(F.col(f"v.{c}"), n)), F.lit(0)).alias(name) for c, name in (
                ("payment_sla_met", "payment_sla_met"), ("inventory_sla_met", "inventory_sla_met"),
                ("paid", "paid"))]).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(sums.groupBy("event_date", "summary_date", "hour").agg(*[
                F.sum(c).alias(c) for c in ("total_orders", "payment_sla_met", "inventory_sla_met")]),
                self.path("gold_hour_deltas"), batch_id, ["event_date"])
            write_batch(sums.groupBy("reconciled_at").agg(
                F.sum("total_orders").alias("orders"), F.sum("paid").alias("paid")).withColumn(
                "reconciled_date", self.partition_of(F.col("reconciled_at"))),
                self.path("gold_clock_deltas"), batch_id, ["reconciled_date"])
        finally:
            sums.unpersist()

    def gold_hours(self, since=None, until=None) -> DataFrame:
        """Changes by hour of the order's time; summed they are what resolved gold would give."""
        return self._dated("gold_hour_deltas", S.GOLD_HOURS, "event_date",
                           "(summary_date + make_dt_interval(0, hour))", since, until)

    def gold_hours_of(self, dates: Iterable[date]) -> DataFrame:
        return read_table(self.spark, self.path("gold_hour_deltas"), S.GOLD_HOURS, "event_date date",
                          any_of("event_date", dates))

    def gold_clocks(self, since=None, until=None) -> DataFrame:
        """Changes by the time of reconciling."""
        return self._dated("gold_clock_deltas", S.GOLD_CLOCKS, "reconciled_date", "reconciled_at",
                           since, until)

    def compact_gold(self, scratch: str, dates: Iterable[date] | None = None) -> None:
        """Make one version of the many in partitions (all unless given), in place.

        The resolved rows go to `scratch`, from there into the folder of the newest batch of their
        date, and then the older folders are removed. A resolved row keeps the first-write columns of
        its first version, so at every point between, and after a crash, the table reads the same.
        The other tables are untouched: later events find their partners as before. No batch may
        run meanwhile.

        The files are laid out for `plans.lookups`: a date's rows are cut into ranges of customer, time
        and order, so one customer's rows lie in few files, however many they are, and Bloom filters
        of both ids let a reader pass over files and row groups that do not hold one.
        """
        versions = self.gold_versions() if dates is None else self.gold_of(dates)
        newest = versions.groupBy("event_date").agg(F.max("batch_id").alias("batch_id"),
                                                    F.min("batch_id").alias("oldest"))
        whole = resolve_gold(versions.drop("event_date")).withColumn(
            "event_date", self.partition_of(F.col("event_timestamp")))
        whole.join(newest.drop("oldest"), "event_date").write.mode("overwrite").parquet(scratch)
        old = versions.select("event_date", "batch_id").distinct().join(
            newest.select("event_date", F.col("batch_id").alias("last")), "event_date").where(
            "batch_id < last").collect()  # a row per folder to remove
        path = self.path("reconciled_order_events")
        layout = ("event_date", "batch_id", "customer_id", *reversed(S.GOLD_KEY))
        (self.spark.read.parquet(scratch).repartitionByRange(*layout).sortWithinPartitions(*layout)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .options(**bloom_filters("customer_id", "order_id"))
         .partitionBy("event_date", "batch_id").parquet(path))
        for row in old:
            remove_folder(self.spark, f"{path}/event_date={row.event_date}/batch_id={row.batch_id}")

    # Metrics: one row per batch.

    def metrics(self, since=None, until=None) -> DataFrame:
        kept = ", ".join(c for c in S.PIPELINE_METRICS.split(", ") if c != "batch_id bigint")
        return self._dated("pipeline_metrics", kept, "batch_date", "batch_timestamp", since,
                           until).select(*[c.split()[0] for c in S.PIPELINE_METRICS.split(", ")])

    def add_metrics(self, counts: DataFrame, batch_id: int) -> None:
        write_batch(pipeline_metrics(counts).drop("batch_id").withColumn(
            "batch_date", self.partition_of(F.col("batch_timestamp"))),
            self.path("pipeline_metrics"), batch_id, ["batch_date"])


def pipeline_metrics(counts: DataFrame) -> DataFrame:
    """Metrics rows from `batch_id, batch_timestamp, input_rows, reconciled_rows, dlq_rows,
    processing_duration_ms` and, where known, `sla_violations`."""
    violations = (F.col("sla_violations") if "sla_violations" in counts.columns
                  else F.lit(None).cast("bigint"))
    rate = ratio(F.col("dlq_rows"), F.greatest(F.col("input_rows"), F.lit(1)), 4)
    return counts.select(
        F.col("batch_id").cast("bigint").alias("batch_id"), "batch_timestamp", "input_rows",
        F.col("dlq_rows").alias("dlq_events"),
        F.col("dlq_rows").alias("reconciliation_failures"),
        rate.try_cast("decimal(6,4)").alias("reconciliation_failure_rate"),
        "reconciled_rows", violations.alias("sla_violations"), "processing_duration_ms")


def overwrite_days(summary: DataFrame, path: str, day_column: str = "summary_date") -> None:
    """Last-wins write of a daily summary: the days in `summary` are replaced, others stay."""
    (summary.hint("rebalance", day_column).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(day_column).parquet(path))


def write_checks(results: DataFrame, path: str, run_id: str) -> None:
    """Check results are few rows per run; a run done again replaces its own."""
    results.coalesce(1).write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def remove_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder, which readers of the target's parent see at once. A target that is there
    already stays, and the source goes."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path(target)):
        files.delete(path(source), True)
        return
    files.mkdirs(path(target).getParent())
    if not files.rename(path(source), path(target)):
        raise OSError(f"{source} could not be moved to {target}")


def now_counts(spark: SparkSession, batch_id: int, as_of=None, **counts: int) -> DataFrame:
    """One row of batch counts as input of `pipeline_metrics`."""
    literals = [F.lit(int(v)).cast("bigint").alias(k) for k, v in counts.items()]
    return spark.range(1, numPartitions=1).select(F.lit(batch_id).cast("bigint").alias("batch_id"),
                                 moment(as_of).alias("batch_timestamp"), *literals)
