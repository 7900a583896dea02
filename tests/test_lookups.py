from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.plans import lookups
from orderloom.sinks.tables import Store

N = 4000


def gold_rows(spark, n=N, batch_time="2024-01-20 00:00:00", customer=None):
    """Orders of 200 customers over two days, one of them with a third of all; ids in no order."""
    k = F.col("id")
    own = F.when(k % 3 == 0, F.lit("C-hot")).otherwise(F.concat(F.lit("C"), (k * 7919 % 200)))
    values = {"order_id": F.concat(F.lit("O"), F.sha1(k.cast("string"))),
              "event_timestamp": F.timestamp_seconds(F.lit(1705190400) + k * 43),
              "customer_id": customer if customer is not None else own,
              "total_amount": F.lit(1), "order_status": F.lit("new"),
              "payment_sla_met": k % 2 == 0, "inventory_sla_met": F.lit(True),
              "reconciled_at": F.lit(batch_time).cast("timestamp"), "k": k}
    fields = [c.split() for c in S.GOLD.split(", ")]
    return spark.range(n).select("id", *[
        values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in fields])


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Compacted gold in many files, and a later batch that renames some customers."""
    root = tmp_path_factory.mktemp("lookups")
    store = Store(spark, f"{root}/tables")
    rows = gold_rows(spark)
    store.add_gold(rows.where("id % 2 = 0").drop("id"), 0)
    store.add_gold(rows.where("id % 2 = 1").drop("id"), 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        store.compact_gold(f"{root}/scratch")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    moved = gold_rows(spark, customer=F.lit("C7"), batch_time="2024-01-21 00:00:00")
    store.add_gold(moved.where("id % 50 = 0").withColumn("payment_sla_met", F.lit(True)).drop("id"), 2)
    return store


def scanned(df):
    """Rows that the file scan of a plan without shuffles put out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def expected(spark, where):
    return {r.order_id for r in gold_rows(spark).where(where).collect()}


@pytest.mark.parametrize("customer", ["C7", "C-hot", "nobody"])
def test_orders_of_a_customer(spark, store, customer):
    got = lookups.orders_of_customer(store, customer).collect()
    assert {r.order_id for r in got} == expected(spark, F.col("customer_id") == customer)
    assert all(r.customer_id == customer for r in got)
    times = [r.event_timestamp for r in got]
    assert times == sorted(times, reverse=True) and len({r.order_id for r in got}) == len(got)
    if got:  # the later batch decides all but the customer
        assert {r.reconciled_at.day for r in got} <= {20, 21}
    some = lookups.orders_of_customer(store, customer, "2024-01-14 06:00:00", "2024-01-15 01:00:00")
    assert {r.order_id for r in some.collect()} == {
        r.order_id for r in got
        if datetime(2024, 1, 14, 6) <= r.event_timestamp < datetime(2024, 1, 15, 1)}


def test_lookups_read_few_rows(spark, store):
    compacted = store.gold_versions().where("batch_id = 1")
    one = gold_rows(spark).where("id = 1234").first()
    assert scanned(compacted.where(F.col("order_id") == one.order_id)) <= N / 8
    assert scanned(compacted.where(F.col("customer_id") == "C7")) <= N / 4
    assert scanned(compacted.where(F.col("customer_id") == "C9999")) == 0
    assert scanned(compacted.where(F.col("order_status") == "new")) == N
    assert compacted.count() == N


def test_an_order_and_its_history(spark, store):
    one = gold_rows(spark).where("id = 50").first()  # changed by the later batch
    assert [r.batch_id for r in lookups.order_history(store, one.order_id).collect()] == [1, 2]
    (now,) = lookups.order_now(store, one.order_id).collect()
    assert (now.customer_id, now.reconciled_at.day) == (one.customer_id, 21)
    assert lookups.order_now(store, "none").collect() == []


def test_recent_orders_and_misses_of_a_time(spark, store):
    since, until = "2024-01-14 12:00:00", "2024-01-15 00:00:00"
    within = f"event_timestamp >= '{since}' AND event_timestamp < '{until}'"
    recent = lookups.recent_orders(store, since, until)
    assert {r.order_id for r in recent.collect()} == expected(spark, within)
    assert len([f for f in recent.inputFiles() if "event_date=2024-01-15" in f]) == 0
    missed = lookups.sla_misses(store, since, until).collect()
    assert {r.order_id for r in missed} == expected(spark, f"{within} AND id % 2 = 1")
