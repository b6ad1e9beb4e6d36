"""Work once for each key of a stream, claims with a lease, and admission by weight."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from framequarry.operators import shard
from framequarry.sinks.commits import CommitLog
from framequarry.streaming.claims import Claims
from framequarry.streaming.once import DoneIndex, first_within, once_stream


def put(folder, name, *keys):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("".join(f"{k}\n" for k in keys))


def stream(spark, folder):
    return spark.readStream.text(folder).select(F.col("value").alias("k"))


def test_the_tenth_batch_reads_no_older_batch(spark, tmp_path):
    seen = []

    def work(new):
        seen.append(sorted(r.k for r in new.collect()))
        return new

    for n in range(10):
        put(f"{tmp_path}/in", f"f{n}", f"a{n}", f"a{max(0, n - 1)}", "a0", f"a{n}")
        once_stream(stream(spark, f"{tmp_path}/in"), "k", f"{tmp_path}/out", f"{tmp_path}/cp", work)
        if os.path.isdir(f"{tmp_path}/out/b{n - 1}"):
            shutil.rmtree(f"{tmp_path}/out/b{n - 1}")  # what an earlier batch found isn't needed
    assert seen == [[f"a{n}"] for n in range(10)]


def test_a_restart_asks_nothing_twice(spark, tmp_path, monkeypatch):
    calls = []

    def work(new):
        calls.append(sorted(r.k for r in new.collect()))
        return new

    put(f"{tmp_path}/in", "f0", "a", "b")
    with monkeypatch.context() as m:
        m.setattr(DoneIndex, "add", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            once_stream(stream(spark, f"{tmp_path}/in"), "k", f"{tmp_path}/out", f"{tmp_path}/cp", work)
    once_stream(stream(spark, f"{tmp_path}/in"), "k", f"{tmp_path}/out", f"{tmp_path}/cp", work)
    put(f"{tmp_path}/in", "f1", "b", "c")
    once_stream(stream(spark, f"{tmp_path}/in"), "k", f"{tmp_path}/out", f"{tmp_path}/cp", work)
    assert calls == [["a", "b"], ["c"]]


def test_index_reads_only_its_buckets_and_knows_null(spark, tmp_path):
    index = DoneIndex(spark, f"file://{tmp_path}/index", 16)
    rows = spark.createDataFrame([(f"k{i}",) for i in range(40)] + [(None,)], "k string")
    assert index.unseen(rows, "k").count() == 41
    index.add(rows.where("k is null or k < 'k2'"), "k", 0)
    index.add(rows.where("k is null or k < 'k2'"), "k", 0)
    one = spark.createDataFrame([("k1",), ("k9",), (None,)], "k string")
    left = index.unseen(one, "k")
    assert [r.k for r in left.collect()] == ["k9"]
    assert "PartitionFilters: [bucket" in left._jdf.queryExecution().toString() or "bucket#" in left._jdf.queryExecution().toString()
    assert spark.read.parquet(f"file://{tmp_path}/index").count() == rows.where("k is null or k < 'k2'").count()


def test_repeats_within_a_horizon_are_dropped_by_state(spark, tmp_path):
    spark.createDataFrame([("a", 0), ("a", 100), ("b", 50), ("a", 5000)], "k string, s int").select("k", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.parquet(f"{tmp_path}/in")
    s = spark.readStream.schema("k string, ts timestamp").parquet(f"{tmp_path}/in")
    first_within(s, ["k"], "ts", "10 minutes").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b"]


@pytest.fixture
def desk(spark, tmp_path):
    queue = spark.createDataFrame([(f"v{i}", i) for i in range(9)] + [("v3", 1), (None, 0)], "id string, ord int")
    return Claims(CommitLog(spark, f"file://{tmp_path}/log"), queue, lease_s=60.0, in_flight=4)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_two_workers_hold_no_id_together_and_a_lost_ones_ids_come_back(spark, desk):
    one, two = desk.take("one", 9, 0.0), desk.take("two", 3, 1.0)
    assert ids(one) == ["v0", "v1", "v2", "v3"] and ids(two) == ["v4", "v5", "v6"]  # bound of four; v3 counts once
    assert ids(desk.take("one", 9, 2.0)) == []  # still holds four
    name = two.first().claim
    desk.finish(name, two.withColumn("size", F.lit(1)).select("id", "size"), 10.0)
    assert ids(desk.take("two", 9, 11.0)) == ["v7", "v8"]
    back = desk.take("two", 9, 65.0)  # one is lost, its lease over
    assert ids(back) == ["v0", "v1"]  # two still holds two
    late = one.withColumn("size", F.lit(9)).select("id", "size")
    desk.finish(one.first().claim, late, 66.0)
    assert ids(desk.log.snapshot().table("results")) == ["v4", "v5", "v6"]
    desk.finish(back.first().claim, back.select("id", F.lit(2).alias("size")), 70.0)
    desk.finish(back.first().claim, back.select("id", F.lit(3).alias("size")), 71.0)
    got = {r.id: r.size for r in desk.log.snapshot().table("results").collect()}
    assert got == {"v4": 1, "v5": 1, "v6": 1, "v0": 2, "v1": 2}
    desk.cut_down(200.0)
    assert desk.log.snapshot().table("claims").count() == 0 and ids(desk.take("three", 9, 200.0)) == ["v2", "v3", "v7", "v8"]


def test_claims_made_at_once_are_apart(spark, desk):
    import threading

    got = {}
    both = [threading.Thread(target=lambda w=w: got.update({w: ids(desk.take(w, 4, 0.0))})) for w in ("one", "two")]
    [t.start() for t in both]
    [t.join() for t in both]
    assert sorted(got["one"] + got["two"]) == [f"v{i}" for i in range(8)]


def test_a_renewed_lease_holds(spark, desk):
    one = desk.take("one", 2, 0.0)
    desk.renew(one.first().claim, 50.0)
    assert ids(desk.take("two", 1, 70.0)) == ["v3"]  # a repeated id goes by its smallest place
    desk.finish(one.first().claim, one.select("id"), 100.0)
    assert ids(desk.log.snapshot().table("results")) == ["v0", "v1"]


@pytest.mark.parametrize("room", [0, 7, 60, 10**9])
def test_admission_by_weight_is_the_running_sum(spark, room):
    rows = [(i, (i * 7) % 5 if i % 6 else None) for i in range(200)]
    got = shard.admit_weight(spark.createDataFrame(rows, "id long, w int").repartition(7), "id", "w", room).collect()
    upto, want = 0, []
    for i, w in rows:
        upto += w or 0
        if upto <= room:
            want.append((i, w, upto))
    assert sorted((r.id, r.w, r.upto) for r in got) == want
    assert shard.admit_weight(spark.createDataFrame([], "id long, w int"), "id", "w", room).collect() == []
