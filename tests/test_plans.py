"""Plans stay in the JVM, prune what they read, and combine before they shuffle."""

import pytest

from orderloom import schemas as S
from orderloom.operators.keyed import first_wins
from orderloom.operators.parse import parse
from orderloom.operators.validate import invalid_rows, validate
from orderloom.plans.queries import QUERIES, parsed_of
from orderloom.sources import derived as D

SF = "/root/testdata/sf0.001"
BATCH = ("reconcile", "recon_unbounded", "recon_legs", "validate_orders", "dlq_from_invalid",
         "gateway_flatten", "check_null_rates", "hourly_sla_backfill", "late_events")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_match_reads_only_its_columns(spark):
    text = plan(QUERIES["reconcile"](spark, SF))
    schemas = [part.split("\n")[0] for part in text.split("ReadSchema: ")[1:]]
    assert schemas and not any("l_extendedprice" in s or "o_orderpriority" in s for s in schemas)


def test_match_has_no_join_of_candidates(spark):
    text = plan(QUERIES["reconcile"](spark, SF))
    assert text.count("Join") == 1  # the one that derives the stock events
    assert text.index("Window") < text.index("partial_min")


def test_documents_are_read_once(spark):
    parsed = parse(D.order_messages(spark, SF), S.ORDERS_TOPIC)
    bad = invalid_rows(validate(parsed, S.ORDERS_TOPIC, D.MESSAGES_AS_OF), S.ORDERS_TOPIC)
    assert plan(bad).count("from_json") == 1


def test_first_row_is_limited_before_the_shuffle(spark):
    text = plan(first_wins(parsed_of(spark, SF, S.ORDERS_TOPIC), ["order_id"], ["source_offset"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_each_leg_is_read_once(spark):
    """The unique side of the unbounded match is a stored table, not a second plan of its input."""
    text = plan(QUERIES["recon_unbounded"](spark, SF))
    assert text.count("orders.parquet") <= 2 and text.count("lineitem.parquet") == 0
