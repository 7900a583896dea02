"""Queries against their SQL. ORDERLOOM_ALL=1 adds those that write tables or run streams."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import compare, database  # noqa: E402
from orderloom.plans.oracles import oracles  # noqa: E402
from orderloom.plans.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
SLOW = {"archive_partitions", "archive_replay", "raw_orders_first_wins", "raw_payments_first_wins",
        "raw_inventory_first_wins", "gold_upsert", "summary_rerun_idempotent",
        "incremental_reconcile", "archive_backfill", "customer_lookup", "order_lookup",
        "src_single_topic", "src_multi_topic", "gateway_two_stage"}


def is_slow(name):
    return name.startswith("stream_") or name in SLOW


NAMES = [n for n in QUERIES if os.environ.get("ORDERLOOM_ALL") or not is_slow(n)]


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracles())
    assert set(entry.queries()) >= set(entry.oracle_sql()) >= set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, name, SF) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
