from datetime import datetime, timedelta

from helpers import AS_OF, inventory_event, messages, order_event, payment_event
import pytest
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.sinks.tables import Store
from orderloom.streaming import backfill as B
from orderloom.streaming.job import process_batch

START, END = "2024-01-14 00:00:00", "2024-01-16 00:00:00"


def at(minutes):
    time = datetime(2024, 1, 14, 20) + timedelta(minutes=minutes)
    return time.strftime("%Y-%m-%dT%H:%M:%S.%f+00:00")


def gold(store):
    return {(r.order_id, r.payment_id, r.inventory_id, r.customer_id) for r in store.gold().collect()}


def live(spark, root):
    """A live run over eight hours with matches across hour and day borders, and its archive."""
    store = Store(spark, f"{root}/live")
    events = []
    for n in range(9):
        minute = 60 * n - 0.3
        events += [(S.ORDERS_TOPIC, order_event(order_id=f"O{n}", event_timestamp=at(minute))),
                   (S.PAYMENTS_TOPIC, payment_event(
                       payment_id=f"P{n}", order_id=f"O{n}", event_timestamp=at(minute + 0.5)))]
    events.append((S.INVENTORY_TOPIC, inventory_event(order_id="O3", occurred_at=at(180))))
    events.append((S.ORDERS_TOPIC, order_event(order_id="BAD", total_amount=-1)))
    for batch in (0, 1):
        process_batch(messages(spark, *events[batch::2]), batch, store, as_of=AS_OF, late_after=None,
                      archive_path=f"{root}/archive")
    return store


def test_hours_are_cut_into_bounded_runs():
    day = datetime(2024, 1, 14)
    hours = [(day + timedelta(hours=h), n) for h, n in ((5, 9), (1, 4), (0, 3), (2, 4), (7, 1))]
    runs = B.cut_hours(hours, day + timedelta(minutes=30), day + timedelta(hours=7, minutes=15), 8)
    assert [(a.hour + a.minute / 60, b.hour + b.minute / 60, n) for a, b, n in runs] == [
        (0.5, 2, 7), (2, 3, 4), (5, 6, 9), (7, 7.25, 1)]
    assert B.cut_hours([], day, day, 8) == []


def test_backfill_gives_the_gold_of_the_live_run(spark, tmp_path):
    want = gold(live(spark, tmp_path))
    assert len(want) == 9 and ("O3", "P3", "I1", "C1") in want
    store = Store(spark, f"{tmp_path}/again")
    given = (store, "jan", f"{tmp_path}/archive", START, END)
    left = B.backfill(*given, max_rows=6, stop_after=2, as_of=AS_OF)
    assert left > 0 and {g[0] for g in gold(store)} < {g[0] for g in want}
    # The next run ends inside its first batch, after its raw rows were written.
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Store, "add_gold", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            B.backfill(*given, max_rows=6, as_of=AS_OF)
    # The stored cut holds, whatever size the later call names.
    assert B.backfill(*given, max_rows=1000, as_of=AS_OF) == 0
    assert gold(store) == want
    for topic in S.TOPICS:
        key = list(S.TOPICS[topic].raw_key)
        assert store.raw(topic).groupBy(*key).count().where("count > 1").isEmpty()
    batches = store.metrics().count()
    assert B.backfill(*given, max_rows=6, as_of=AS_OF) == 0
    assert store.metrics().count() == batches


def test_backfill_of_a_range_and_of_nothing(spark, tmp_path):
    live(spark, tmp_path)
    store = Store(spark, f"{tmp_path}/part")
    path = f"{tmp_path}/archive"
    assert B.backfill(store, "none", path, "2023-01-01", "2023-01-02", as_of=AS_OF) == 0
    assert B.backfill(store, "gone", f"{tmp_path}/nothing", START, END, as_of=AS_OF) == 0
    assert gold(store) == set()
    B.backfill(store, "part", path, "2024-01-14 20:30:00", "2024-01-14 22:00:00", as_of=AS_OF)
    assert {o for o, *_ in gold(store)} == {"O1", "O2"}
    times = store.raw(S.PAYMENTS_TOPIC).agg(F.max("event_timestamp").cast("string")).first()[0]
    assert times < "2024-01-14 22:00:00"
    # Another backfill into the same store goes on with its ids; what is stored stays.
    B.backfill(store, "all", path, START, END, first_batch=1, as_of=AS_OF)
    assert len(gold(store)) == 9
