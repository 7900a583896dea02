"""Queries that use rows several times compute them once, and read each message once."""

import pytest
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.operators import reconcile as R
from orderloom.plans import queries
from orderloom.sinks.tables import Store

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def seen(monkeypatch):
    """Plans of the rows handed to a function, by the function's name."""
    def watch(owner, name, pick, result):
        plans = []
        monkeypatch.setattr(owner, name, lambda *a, **k: plans.append(plan(pick(*a))) or result)
        return plans
    return watch


def test_changes_of_gold_come_from_one_match(spark, seen, monkeypatch):
    monkeypatch.setattr(Store, "add_gold_deltas", lambda *a: None)
    plans = seen(Store, "add_gold", lambda self, rows, batch: rows, {})
    queries._with_changes(spark, SF)
    assert len(plans) == 4 and not any("Exchange" in p for p in plans)


def test_second_try_of_an_upsert_has_the_rows_of_the_first(spark, seen):
    plans = seen(Store, "add_gold", lambda self, rows, batch: rows, {})
    queries._upserted(spark, SF)
    assert ["Exchange" in p for p in plans] == [True, False, False]


def test_summary_reruns_share_one_match(spark, seen, monkeypatch):
    tables = seen(queries.summary, "hourly_sla_summary", lambda gold, as_of: gold, None)
    monkeypatch.setattr(queries, "overwrite_days", lambda *a: None)
    with pytest.raises(Exception):  # nothing was written to read back
        queries.QUERIES["summary_rerun_idempotent"](spark, SF)
    assert len(tables) == 3 and not any("Exchange" in p for p in tables)


def test_both_runs_of_the_checks_share_one_match(spark, seen, monkeypatch):
    golds = seen(queries.quality, "all_checks", lambda raw, gold, *rest: gold, None)
    monkeypatch.setattr(queries, "write_checks", lambda *a: None)
    with pytest.raises(Exception):
        queries.QUERIES["quality_all"](spark, SF).collect()
    assert len(golds) == 2 and not any("Exchange" in p for p in golds)


def test_gold_of_the_live_summary_is_made_before_the_stream(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(queries, "play", lambda spark, slices, run: plans.extend(
        plan(rows) for part in slices for rows in part.values()))
    with pytest.raises(Exception):
        queries.QUERIES["stream_hourly_sla"](spark, SF).collect()
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)


def test_few_legs_are_placed_in_two_slices(spark):
    width = R.reconcile.__kwdefaults__["slice_seconds"]
    assert S.JOIN_WINDOW_SECONDS / width <= 0.1


def test_rejects_are_found_in_one_reading(spark):
    df = queries.QUERIES["dlq_from_invalid"](spark, SF)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == len(S.TOPICS)


def test_stream_slices_are_cut_in_one_writing(spark, tmp_path):
    path, out = str(tmp_path / "in"), []
    rows = spark.range(12, numPartitions=3)
    schema = rows.schema

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{path}/*")
        return queries.streams.each_batch(
            stream, lambda df, n: out.append((n, sorted(r.id for r in df.collect()))),
            str(tmp_path / "cp"))

    part = F.when(F.col("id") < 5, 0).when(F.col("id") < 11, 2)  # none in 1, one row in none
    queries.play_cut(spark, rows, part, 3, path, run)
    assert [ids for n, ids in out if ids] == [[0, 1, 2, 3, 4], [5, 6, 7, 8, 9, 10]]
    assert len(out) == 3
    empty = str(tmp_path / "none")
    queries.play_cut(spark, rows.limit(0), part, 1, empty, lambda: queries.streams.each_batch(
        spark.readStream.schema(schema).parquet(f"{empty}/*"), lambda df, n: out.append(df.count()),
        str(tmp_path / "cp2")))
    assert out[-1] == 0


def test_the_text_of_a_raw_event_is_not_shuffled(spark, tmp_path, monkeypatch):
    from orderloom.sinks import tables
    shuffled, write = [], tables.write_batch

    def watched(rows, path, *rest):
        if path.endswith("raw_order_events"):
            shuffled.append(rows.columns)
            shuffled.append(plan(rows))
        return write(rows, path, *rest)

    monkeypatch.setattr(tables, "write_batch", watched)
    store = Store(spark, str(tmp_path))
    rows = queries.D.orders_ev(spark, SF).limit(20).drop("k", "ingested_at")
    found = store.add_raw(rows.unionByName(rows.withColumn("status", F.lit("zz"))),
                          S.ORDERS_TOPIC, 0, as_of="2024-01-15 10:00:00")
    assert "raw_payload" not in shuffled[0] and "to_json" not in shuffled[1]
    assert found["rows"] == 20 and found["raw_payload"] == 0
    stored = store.raw(S.ORDERS_TOPIC)
    assert stored.where("status = 'zz'").isEmpty()  # of copies, the first by their columns
    body = F.from_json("raw_payload", "order_id string, status string, event_timestamp timestamp")
    assert stored.where((body["order_id"] == F.col("order_id")) & (body["status"] == F.col("status"))
                        & (body["event_timestamp"] == F.col("event_timestamp"))).count() == 20
    assert {str(r.ingested_at) for r in stored.collect()} == {"2024-01-15 10:00:00"}


@pytest.mark.parametrize("topic", list(S.TOPICS))
def test_a_time_is_read_once_when_an_event_is_judged(spark, topic):
    checked = queries.job.check_events(
        queries.MESSAGES[topic](spark, SF), topic, 0, queries.D.MESSAGES_AS_OF, keep_text=False)
    text = checked._jdf.queryExecution().optimizedPlan().toString()
    assert text.count(r"^\d{4}-") == 1
    kept = F.col("failure_reason").isNull()
    found = checked.agg(
        F.count_if(kept & F.col("value").isNotNull()).alias("texts"), F.count_if(kept).alias("kept"),
        F.count_if(~kept & F.col("value").isNotNull()).alias("rejected")).first()
    assert found.texts == 0 and found.kept > 0 and found.rejected > 0


def test_messages_of_one_topic_are_read_from_its_archive_alone(spark, tmp_path):
    from orderloom.operators.parse import route
    rows = spark.range(3).select(
        F.lit("{}").alias("value"), F.lit("x").alias("source_topic"), F.col("id").alias("source_offset"),
        F.lit("2024-01-15 10:00:00").cast("timestamp").alias("broker_timestamp"),
        F.lit("2024-01-15 10:00:00").cast("timestamp").alias("event_timestamp"))
    for topic in S.TOPICS:
        queries.archives.archive(rows, f"{tmp_path}/{topic}", 0)
    messages = queries.backfill.archived_messages(spark, str(tmp_path), "2024-01-15", "2024-01-16")
    one = route(messages, S.PAYMENTS_TOPIC)
    assert one.count() == 3 and messages.count() == 9
    assert one._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_what_is_archived_for_a_backfill_is_not_parsed_first(spark, seen, monkeypatch):
    monkeypatch.setattr(queries.backfill, "backfill", lambda *a, **k: None)
    plans = seen(queries.archives, "archive", lambda events, *rest: events, None)
    with pytest.raises(Exception):  # nothing was archived to count
        queries.QUERIES["archive_backfill"](spark, SF)
    assert plans and not any("from_json" in p for p in plans)


def test_the_stream_match_keeps_an_order_once(spark, tmp_path):
    def source(df):
        path = str(tmp_path / df.columns[0])
        df.limit(1).write.parquet(path)
        return spark.readStream.schema(df.schema).parquet(path)

    match = queries.interval.match_stream(
        *[source(df) for df in (queries.D.orders_ev(spark, SF).drop("k"),
                                queries.D.payments_ev(spark, SF).drop("k", "attempt"),
                                queries.D.inventory_ev(spark, SF).drop("k", "l_linenumber"))])
    text = match._jdf.queryExecution().analyzed().toString()
    assert text.count("Join LeftOuter") == 1 and text.count("EventTimeWatermark") == 3


def test_inputs_of_the_stream_match_are_written_once(spark, monkeypatch):
    cuts = []
    monkeypatch.setattr(queries, "cut", lambda spark, rows, part, count, path: cuts.append(
        (path.rsplit("/", 1)[-1], count)) or (lambda n: rows.limit(0).write.parquet(f"{path}/{n}")),
        raising=False)
    assert queries.QUERIES["stream_reconcile"](spark, SF).count() == 0
    assert cuts == [("orders", 2), ("payments", 2), ("inventory", 2)]


def test_times_are_read_once_where_lengths_are_checked(spark):
    df = queries.QUERIES["validate_lengths"](spark, SF)
    assert df._jdf.queryExecution().optimizedPlan().toString().count(r"^\d{4}-") == len(S.TOPICS)


def test_lengths_are_looked_at_before_a_time_is_read(spark):
    df = queries.QUERIES["validate_lengths"](spark, SF)
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    reads = [i for i, line in enumerate(lines) if "Generate explode" in line and r"^\d{4}-" in line]
    assert len(reads) == len(S.TOPICS)
    # What a line of a plan works on comes below it, up to the reading of the message.
    for i in reads:
        below = lines[i + 1:next(j for j in range(i, len(lines)) if "from_json(" in lines[j])]
        assert any("Filter" in line and "length(" in line for line in below)


@pytest.mark.parametrize("name", ["validate_lengths", "parse_failures", "dlq_from_invalid"])
def test_messages_to_be_parsed_lie_in_even_pieces(spark, name):
    text = plan(queries.QUERIES[name](spark, SF))
    assert "REPARTITION_BY_COL" not in text  # adaptive execution merges those by their bytes
    assert text.count("REPARTITION_BY_NUM") == 4  # orders three times, lineitem once
    assert f", {queries.D.even_pieces(spark)}), REPARTITION_BY_NUM" in text
    assert queries.D.even_pieces(spark) >= 4 * spark.sparkContext.defaultParallelism


def test_gold_of_few_dates_is_not_gathered(spark, monkeypatch):
    hints, kind = [], type(spark.range(1))
    monkeypatch.setattr(kind, "hint", lambda self, *a: hints.append(a) or self)
    queries._upserted(spark, SF)
    assert hints == []
    queries.QUERIES["incremental_reconcile"](spark, SF)
    assert hints == []


def test_messages_go_once_their_batch_is_done(spark, tmp_path, monkeypatch):
    path, seen = tmp_path / "in", []
    rows = spark.range(6, numPartitions=2)

    def run():
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/*")
        return queries.streams.each_batch(stream, lambda df, n: seen.append(df.count()), str(tmp_path / "cp"))

    queries.play_cut(spark, rows, F.col("id") % 3, 3, str(path), run)
    assert seen == [2, 2, 2] and not list(path.iterdir())


def test_checked_events_are_tables_that_go(spark, tmp_path, monkeypatch):
    from orderloom.streaming import job
    monkeypatch.setattr(job, "work_dir", lambda spark, label: str(tmp_path / label))
    plans, facts = [], job.batch_facts

    def watched(store, checked, stray):
        plans.extend(plan(df) for df in checked.values())
        return facts(store, checked, stray)

    monkeypatch.setattr(job, "batch_facts", watched)
    store = Store(spark, str(tmp_path / "store"), grain="year")
    job.process_batch(queries.D.order_messages(spark, SF), 0, store, as_of=queries.D.MESSAGES_AS_OF)
    assert len(plans) == 3 and not any("InMemoryTableScan" in p or "from_json" in p for p in plans)
    assert store.gold().count() > 0 and not (tmp_path / "checked").exists()


def test_streams_keep_state_on_disk_in_any_session(spark):
    name, unset = "spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.stateStore.rocksdb.x"
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    with queries.setting(spark, name, default), queries.setting(spark, unset, 1):
        with queries.stream_width(spark):
            assert spark.conf.get(name).endswith(".RocksDBStateStoreProvider")
        assert spark.conf.get(name) == default
    assert spark.conf.get(unset, None) is None


def test_shuffle_files_of_an_archive_go_once_it_is_written(spark, tmp_path, monkeypatch):
    from orderloom.sources import archive
    freed = []
    monkeypatch.setattr(archive, "release", lambda spark: freed.append(list(tmp_path.iterdir())))
    archive.archive(spark.range(3).withColumn("event_timestamp", F.lit("2024-01-15").cast("timestamp")),
                    str(tmp_path / "a"), 0)
    assert freed == [[tmp_path / "a"]]
