"""The commit log: tables change together, writers that meet lose nothing, a killed writer leaves the old version."""

import threading

import pytest
from pyspark.sql import functions as F

from framequarry.sinks.commits import Change, CommitLog, Conflict, commit_stream


@pytest.fixture
def log(spark, tmp_path):
    return CommitLog(spark, f"file://{tmp_path}/log")


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, v int")


def held(log, name="t"):
    return sorted((r.k or "", r.v) for r in log.snapshot().table(name).collect())


def test_upsert_keeps_the_first_of_each_key_over_all_commits(spark, log):
    def put(*pairs):
        return log.commit(lambda s: {"t": Change(rows(spark, *pairs), "upsert", "k", "v")})

    assert [put(("a", 1), ("b", 2), ("a", 0)), put(("b", 9), ("c", 3), (None, 4)), put((None, 5), ("d", 6))] == [1, 2, 3]
    assert held(log) == [("", 4), ("a", 0), ("b", 2), ("c", 3), ("d", 6)]
    assert sorted((r.k, r.v) for r in log.snapshot(1).table("t").collect()) == [("a", 0), ("b", 2)]


def test_frames_and_status_in_one_commit(spark, log):
    log.commit(lambda s: {"frames": Change(rows(spark, ("f1", 1)), "upsert", "k"), "status": Change(rows(spark, ("v1", 1)))})
    s = log.snapshot()
    assert "frames" in s and "status" in s and "other" not in s and s.version == 1


def test_two_writers_at_once_lose_no_key_and_write_none_twice(spark, log):
    """Both start from the same snapshot: each build waits for the other one's first."""
    meet, errors = threading.Barrier(2), []

    def write(name, start):
        first = [True]

        def build(snapshot):
            if first.pop() if first else False:
                meet.wait(60)
            return {"t": Change(rows(spark, *((f"k{i}", start) for i in range(start, start + 6))), "upsert", "k"), "by": Change(rows(spark, (name, start)))}

        try:
            log.commit(build)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    both = [threading.Thread(target=write, args=a) for a in (("one", 0), ("two", 3))]
    [t.start() for t in both]
    [t.join() for t in both]
    assert not errors and log.versions() == [1, 2]
    assert [k for k, _ in held(log)] == [f"k{i}" for i in range(9)]
    assert held(log, "by") == [("one", 0), ("two", 3)]


def test_many_writers_that_only_add_need_no_second_build(spark, log):
    builds = []

    def write(i):
        def build(snapshot):
            builds.append(i)
            return {"t": Change(rows(spark, (f"k{i}", i)))}

        log.commit(build)

    writers = [threading.Thread(target=write, args=(i,)) for i in range(5)]
    [t.start() for t in writers]
    [t.join() for t in writers]
    assert sorted(builds) == list(range(5)) and held(log) == [(f"k{i}", i) for i in range(5)]


def test_a_writer_killed_between_its_files_leaves_the_old_version(spark, log, monkeypatch):
    log.commit(lambda s: {"frames": Change(rows(spark, ("a", 1))), "status": Change(rows(spark, ("a", 1)))})
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "_claim", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            log.commit(lambda s: {"frames": Change(rows(spark, ("b", 2))), "status": Change(rows(spark, ("b", 2)))})

    def failing(s):
        return {"frames": Change(rows(spark, ("c", 3))), "status": Change(rows(spark, ("c", 3)).withColumn("v", F.raise_error(F.lit("lost")).cast("int")))}

    with pytest.raises(Exception, match="lost"):
        log.commit(failing)
    assert held(log, "frames") == held(log, "status") == [("a", 1)]
    assert log.vacuum(older_s=3600) == 0  # might belong to a living writer
    assert log.vacuum(older_s=0) >= 2 and held(log, "frames") == [("a", 1)]


def test_a_half_written_commit_is_no_commit(spark, log, tmp_path):
    log.commit(lambda s: {"t": Change(rows(spark, ("a", 1)))})
    (tmp_path / "log" / "_log" / ".half").write_text('{"tables": {')
    assert log.snapshot().version == 1 and held(log) == [("a", 1)]


def test_tries_are_bounded(spark, log):
    def always_late(snapshot):
        other = CommitLog(spark, log.folder)
        other.commit(lambda s: {"t": Change(rows(spark, ("x", s.version)))})
        return {"t": Change(rows(spark, ("y", 0)), "upsert", "k")}

    with pytest.raises(Conflict):
        log.commit(always_late, tries=2)
    assert {k for k, _ in held(log)} == {"x"}


def test_read_tables_are_depended_on(spark, log):
    seen = []

    def build(s):
        seen.append(s.version)
        if s.version == 0:
            CommitLog(spark, log.folder).commit(lambda s: {"other": Change(rows(spark, ("x", 1)))})
        return {"t": Change(rows(spark, ("y", s.version)))}

    log.commit(build, reads=("other",))
    assert seen == [0, 1] and held(log) == [("y", 1)]


def test_replace_compact_empty_tables_and_wrong_columns(spark, log):
    log.commit(lambda s: {"t": Change(rows(spark).limit(0) if False else spark.createDataFrame([], "k string, v int"))})
    assert held(log) == []
    for i in range(3):
        log.commit(lambda s, i=i: {"t": Change(rows(spark, (f"k{i}", i)))})
    log.compact("t")
    assert len(log.snapshot().tables["t"]["parts"]) == 1 and len(held(log)) == 3
    log.commit(lambda s: {"t": Change(rows(spark, ("only", 1)), "replace")})
    assert held(log) == [("only", 1)]
    with pytest.raises(ValueError):
        log.commit(lambda s: {"t": Change(spark.createDataFrame([(1,)], "other int"))})
    assert log.commit(lambda s: {}) == log.snapshot().version


def test_csv_beside_parquet(spark, tmp_path):
    log = CommitLog(spark, f"file://{tmp_path}/pair", csv=True)
    log.commit(lambda s: {"t": Change(rows(spark, ('say "x", y', 1)))})
    (part,) = log.snapshot().tables["t"]["parts"]
    assert [tuple(r) for r in spark.read.csv(f"{log.folder}/{part}.csv", header=True, quote='"', escape='"', schema="k string, v int").collect()] == [('say "x", y', 1)]


def test_a_stream_commits_every_few_rows_and_a_crash_costs_one_portion(spark, log, tmp_path):
    spark.range(100).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("int").alias("v")).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k string, v int").parquet(f"{tmp_path}/in")
    calls = []

    def build(crash_at):
        def make(part, snapshot):
            calls.append(sorted(r.k for r in part.collect()))
            if len(calls) == crash_at:
                raise RuntimeError("crash")
            return {"t": Change(part, "upsert", "k")}

        return make

    with pytest.raises(Exception, match="crash"):
        commit_stream(stream, log, "app", f"{tmp_path}/cp", build(3), key="k", every=25)
    assert len(log.versions()) == 2 and 0 < len(held(log)) < 100
    commit_stream(stream, log, "app", f"{tmp_path}/cp", build(0), key="k", every=25)
    assert len(log.versions()) == 4 and len(held(log)) == 100
    done = [k for c in (calls[:2] + calls[3:]) for k in c]
    assert len(done) == len(set(done)) == 100 and max(map(len, calls)) < 60
    commit_stream(stream, log, "app", f"{tmp_path}/cp", build(0), key="k", every=25)
    assert len(log.versions()) == 4
