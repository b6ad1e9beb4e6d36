"""The resolver in one go: order, failures that make room, waits, fetching, and the depth of the queue."""

import pytest

from framequarry import models
from framequarry.sinks.commits import CommitLog
from framequarry.streaming.batch_resolver import attempts, fetch, queue_depth, resolve_batch


def service():
    """Every third id has no address."""
    return models.call_column(lambda: lambda i: (404, None, {}) if int(i[1:]) % 3 == 0 else (200, f"http://x/{i}", {}), 1, lambda s: None)


@pytest.fixture
def log(spark, tmp_path):
    return CommitLog(spark, f"file://{tmp_path}/log")


def test_batches_in_order_with_waits_and_results(spark, log):
    ids = spark.createDataFrame([(f"v{i}", i) for i in range(12)] + [("v4", 0), (None, 0)], "id string, ord int")
    done = spark.createDataFrame([("v1",)], "id string")
    assert queue_depth(log) == 0
    first = sorted(r.id for r in resolve_batch(log, ids, done, service(), 0.0, batch=4, wait_s=100.0).collect())
    assert first == ["v2", "v4", "v5", "v7"]  # v4 is first by its smallest place; v0, v3 and v6 have none and count as tried
    assert queue_depth(log) == 4 and {r.id for r in attempts(log.snapshot()).collect()} == {f"v{i}" for i in (0, 2, 3, 4, 5, 6, 7)}
    second = sorted(r.id for r in resolve_batch(log, ids, done, service(), 50.0, batch=4, wait_s=100.0).collect())
    assert second == ["v10", "v11", "v8"]  # nothing else is due
    assert fetch(log, spark.createDataFrame([("v2", 5), ("v4", 6), ("v4", 6), ("zz", 1)], "id string, size int")) == 5
    third = sorted(r.id for r in resolve_batch(log, ids, done, service(), 101.0, batch=9, wait_s=100.0).collect())
    assert third == ["v5", "v7"]  # out for too long: sent again; those that came back aren't
    assert queue_depth(log) == 5 and sorted(r.id for r in log.snapshot().table("results").collect()) == ["v2", "v4"]


def test_nothing_to_do(spark, log):
    none = spark.createDataFrame([], "id string, ord int")
    assert resolve_batch(log, none, none.select("id"), service(), 0.0).collect() == []
    assert fetch(log, spark.createDataFrame([("a", 1)], "id string, size int")) == 0
