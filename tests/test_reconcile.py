import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from helpers import inventory, orders, payments

from orderloom.operators import reconcile as R

T0 = datetime(2024, 1, 15, 10, 0, 0)


def at(seconds):
    return (T0 + timedelta(seconds=seconds)).isoformat(sep=" ", timespec="microseconds")


def match(spark, o, p=(), i=(), **kw):
    none_p = payments(spark, ("x", "NONE", at(0), "x"))
    none_i = inventory(spark, ("x", "NONE", at(0), "x"))
    return R.reconcile(orders(spark, *o), payments(spark, *p) if p else none_p,
                       inventory(spark, *i) if i else none_i, as_of=at(0), **kw)


@pytest.mark.parametrize("seconds,found", [
    (-1, False), (0, True), (0.000001, True), (60, True), (60.000001, False), (61, False)])
def test_window_includes_both_ends(spark, seconds, found):
    row = match(spark, [("O1", "ORDER_CREATED", at(0))],
                [("P1", "PAYMENT_CONFIRMED", at(seconds), "O1")],
                [("I1", "INVENTORY_RESERVED", at(seconds), "O1")]).first()
    assert (row.payment_id is not None, row.inventory_id is not None) == (found, found)
    assert (row.payment_sla_met, row.inventory_sla_met) == (found, found)


def test_earliest_payment_and_smallest_id_win(spark):
    row = match(spark, [("O1", "ORDER_CREATED", at(0))], [
        ("P9", "PAYMENT_CONFIRMED", at(30), "O1"), ("P2", "PAYMENT_CONFIRMED", at(10), "O1"),
        ("P1", "PAYMENT_CONFIRMED", at(10), "O1"), ("P0", "PAYMENT_FAILED", at(5), "O1")]).first()
    assert (row.payment_id, row.payment_latency_seconds) == ("P1", Decimal("10.00"))


def test_only_created_orders_and_reserved_stock_count(spark):
    out = match(spark, [("O1", "ORDER_UPDATED", at(0)), ("O2", "ORDER_CREATED", at(0))], (),
                [("I1", "INVENTORY_RELEASED", at(1), "O2")])
    assert [(r.order_id, r.inventory_id) for r in out.collect()] == [("O2", None)]


def test_latency_is_rounded_half_up(spark):
    row = match(spark, [("O1", "ORDER_CREATED", at(0))],
                [("P1", "PAYMENT_CONFIRMED", at(1.805), "O1")]).first()
    assert row.payment_latency_seconds == Decimal("1.81")


def test_limit_shorter_than_window(spark):
    row = match(spark, [("O1", "ORDER_CREATED", at(0))],
                [("P1", "PAYMENT_CONFIRMED", at(50), "O1")], sla=30).first()
    assert row.payment_id == "P1" and not row.payment_sla_met


def brute_force(o, p, i, window=60):
    out = {}
    for order_id, kind, ts in o:
        if kind != "ORDER_CREATED":
            continue
        t = datetime.fromisoformat(ts)

        def pick(events, wanted):
            near = [(datetime.fromisoformat(e[2]), e[0]) for e in events
                    if e[3] == order_id and e[1] == wanted
                    and 0 <= (datetime.fromisoformat(e[2]) - t).total_seconds() <= window]
            return min(near)[1] if near else None

        out[order_id, t] = (pick(p, "PAYMENT_CONFIRMED"), pick(i, "INVENTORY_RESERVED"))
    return out


@pytest.mark.parametrize("slice_seconds", [60, 75, 300])
def test_matches_brute_force_with_one_hot_order(spark, slice_seconds):
    """A third of all events share one order id; slices are cut at many places."""
    rng = random.Random(slice_seconds)

    def order_id():
        return "HOT" if rng.random() < 0.34 else f"O{rng.randrange(12)}"

    def moment():
        return at(rng.choice([rng.randrange(-400, 400), rng.uniform(-400, 400)]))

    o = [(order_id(), rng.choice(["ORDER_CREATED", "ORDER_CREATED", "ORDER_UPDATED"]), moment())
         for _ in range(200)]
    p = [(f"P{n}", rng.choice(["PAYMENT_CONFIRMED", "PAYMENT_FAILED"]), moment(), order_id())
         for n in range(200)]
    i = [(f"I{n}", rng.choice(["INVENTORY_RESERVED", "INVENTORY_RELEASED"]), moment(), order_id())
         for n in range(200)]
    got = {(r.order_id, r.event_timestamp): (r.payment_id, r.inventory_id)
           for r in match(spark, o, p, i, slice_seconds=slice_seconds).collect()}
    want = brute_force(o, p, i)
    assert len(got) == len(want)
    as_naive = {(k[0], k[1].replace(tzinfo=None)): v for k, v in got.items()}
    assert as_naive == want


def test_unbounded_keeps_early_payment_and_counts_all(spark):
    o = orders(spark, ("O1", "ORDER_CREATED", at(0)), ("O1", "ORDER_SHIPPED", at(500)),
               ("O2", "ORDER_CREATED", at(0)))
    p = payments(spark, ("P1", "PAYMENT_FAILED", at(-100), "O1"),
                 ("P2", "PAYMENT_CONFIRMED", at(1000), "O1"),
                 ("P3", "PAYMENT_CANCELLED", at(1), "O2"))
    i = inventory(spark, ("I1", "INVENTORY_RESERVED", at(61), "O1"))
    o = o.unionByName(orders(spark, (None, "ORDER_CREATED", at(0))))  # kept, as every order event
    out = {(r.order_id, r.payment_id, r.inventory_id, r.payment_matches, r.inventory_matches,
            r.payment_sla_met, r.inventory_sla_met) for r in R.reconcile_unbounded(o, p, i).collect()}
    assert out == {("O1", "P1", "I1", 2, 1, True, False), ("O1", "P1", "I1", 2, 1, True, True),
                   ("O2", None, None, 0, 0, False, False), (None, None, None, 0, 0, False, False)}
    legs = R.unbounded_legs(o, p, i)
    assert {(r.leg_id, r.latency_seconds) for r in legs.collect()} == {
        ("P1", Decimal("-100.00")), ("P2", Decimal("1000.00")), ("I1", Decimal("61.00"))}


def test_limits_are_exact_and_of_their_own(spark):
    o = orders(spark, ("O1", "ORDER_CREATED", "2024-01-15 10:00:00"))
    p = payments(spark, ("P1", "PAYMENT_CONFIRMED", "2024-01-15 10:01:00.004", "O1"))
    i = inventory(spark, ("I1", "INVENTORY_RESERVED", "2024-01-15 10:00:50", "O1"))
    row = R.reconcile(o, p, i, join_window=120).first()
    assert (row.payment_latency_seconds, row.payment_sla_met, row.inventory_sla_met) == (
        Decimal("60.00"), False, True)
    row = R.reconcile(o, p, i, join_window=120, sla=61, inventory_sla=45).first()
    assert (row.payment_sla_met, row.inventory_sla_met) == (True, False)
    assert not R.reconcile_unbounded(o, p, i).first().payment_sla_met


def test_matched_and_unmatched_split_all_rows(spark):
    gold = match(spark, [(f"O{n}", "ORDER_CREATED", at(n)) for n in range(6)],
                 [("P1", "PAYMENT_CONFIRMED", at(2), "O1")],
                 [("I2", "INVENTORY_RESERVED", at(3), "O2")])
    assert R.matched_rows(gold).count() == 2
    lost = R.unmatched_rows(gold)
    assert lost.count() == 4
    assert {r.failure_reason for r in lost.collect()} == {R.UNMATCHED}
    assert R.unmatched_rows(gold, older_than=at(4)).count() == 2  # O0 and O3


def test_events_without_order_id_are_ignored(spark):
    out = match(spark, [("O1", "ORDER_CREATED", at(0))],
                [("P1", "PAYMENT_CONFIRMED", at(1), None)],
                [("I1", "INVENTORY_RESERVED", at(1), None)])
    assert out.count() == 1 and out.first().payment_id is None
