"""The ledger queries over all events: nothing of the table is left out."""

import os

import pytest

from framequarry.queries import QUERIES

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def events(spark):
    rows = spark.read.parquet(f"{DIR}/events.parquet").selectExpr("event_id", "user_id", "event_type", "date_diff(cast(ts as date), date'1970-01-01') as day").collect()
    return [(r.event_id, f"{r.user_id}_{r.day}", r.event_type) for r in rows]


def ids(events, *kinds):
    return {u for _, u, t in events if t in kinds}


def test_ledgers_hold_all_events(spark, events):
    got = {n: sorted(r.id for r in QUERIES[n](spark, DIR).collect()) for n in ("ledger_union_all", "ledger_requeue_all", "ledger_pending_all")}
    assert got["ledger_union_all"] == sorted(ids(events, "click", "purchase"))
    assert got["ledger_requeue_all"] == sorted(ids(events, "click") - ids(events, "purchase"))
    assert got["ledger_pending_all"] == sorted(ids(events, "view") - ids(events, "click", "purchase"))
    assert all(got.values())


def test_every_purchase_is_a_try(spark, events):
    out = QUERIES["attempts_give_up_all"](spark, DIR).collect()
    assert sum(r.tries for r in out) == sum(t == "purchase" for _, _, t in events)
    assert {r.id for r in out} == ids(events, "purchase") and {r.given_up for r in out} <= {True, False}


def test_upsert_takes_new_keys_from_every_event(spark, events):
    out = {r.k: r.event_id for r in QUERIES["upsert_keep_first_all"](spark, DIR).collect()}
    assert set(out) == {u for _, u, _ in events}
    assert any(e % 6 == 1 for e in out.values())
