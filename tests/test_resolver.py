"""The resolver by state and timers: replays against a plain simulation, however they are cut; dispatches against ``resolve_now``."""

import os
import random
import time

import pytest

from framequarry.sinks.commits import Change, CommitLog
from framequarry.streaming.queries import resolve_now
from framequarry.streaming.resolver import cut_down, due_signals, resolve

SCHEMA = "id string, kind string, ord long, ts double"
ORDER = ["done", "sent", "ask"]


def simulate(rows, wait, most, end):
    """All signals by ``end``, id by id, in plain Python."""
    out = []
    for i in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == i), key=lambda r: (r[3], ORDER.index(r[1])))
        tries, due, closed, waits, order = 0, None, False, False, None
        for _, kind, o, at in [*mine, (i, None, None, end)]:
            if due is not None and due <= at:
                out.append((i, order, tries, due, "due"))
                due, waits = None, True
            if kind == "done" and not closed:
                if waits:
                    out.append((i, order, tries, at, "withdrawn"))
                closed, due, waits = True, None, False
            elif kind == "ask" and order is None and not closed:
                order, waits = o, True
                out.append((i, order, 0, at, "due"))
            elif kind == "sent" and waits:
                tries, waits = tries + 1, False
                if tries >= most:
                    closed = True
                    out.append((i, order, tries, at, "given_up"))
                else:
                    due = at + wait
    return sorted(out)


def write(spark, folder, *parts):
    """One file for each part, in this order by time."""
    for rows in parts:
        n = len(os.listdir(folder)) if os.path.isdir(folder) else 0
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        for f in os.listdir(folder):
            if f.startswith("part-") and os.path.getmtime(f"{folder}/{f}") > 1e9 + 1000:
                os.utime(f"{folder}/{f}", (1e9 + n, 1e9 + n))


def signals(spark, tmp_path, parts, **rules):
    write(spark, f"{tmp_path}/in", *parts)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out, cp = f"{tmp_path}/out", f"{tmp_path}/cp"
    due_signals(stream, event_time=True, **rules).writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination()
    return sorted((r.id, r.ord, r.try_no, r.at, r.signal) for r in spark.read.parquet(out).collect())


@pytest.mark.parametrize("cuts", [1, 5])
def test_replay_is_the_same_however_it_is_cut(spark, tmp_path, cuts):
    r = random.Random(8)
    rows = sorted(((f"v{r.randrange(12)}", r.choice(["ask", "ask", "sent", "sent", "sent", "done"]), r.randrange(100), 1000.0 + k * 7) for k in range(160)), key=lambda x: x[3])
    size = -(-len(rows) // cuts)
    got = signals(spark, tmp_path, [rows[i : i + size] for i in range(0, len(rows), size)], wait_s=60.0, most=3, remember_s=None)
    assert got == simulate(rows, 60.0, 3, rows[-1][3])
    assert {s for *_, s in got} == {"due", "withdrawn", "given_up"}


def test_nulls_other_kinds_and_an_empty_stream(spark, tmp_path):
    rows = [(None, "ask", 1, 5.0), ("a", "other", 1, 6.0), ("a", "ask", None, 7.0), ("b", "ask", 2, None), ("a", "ask", 3, 8.0)]
    assert signals(spark, tmp_path, [rows]) == [("a", -1, 0, 7.0, "due")]
    assert signals(spark, f"{tmp_path}/none", [[]]) == []


def state_rows(spark, cp):
    return spark.read.format("statestore").option("stateVarName", "id_state").load(cp).count()


def test_state_holds_only_ids_that_still_matter(spark, tmp_path):
    """Of 200 ids that are done only their marks stay, and these for a while."""
    wave = lambda k, n: [(f"w{k}_{i}", kind, i, 1000.0 * k + t) for i in range(n) for t, kind in ((1, "ask"), (2, "sent"), (3, "done"))]
    signals(spark, tmp_path, [wave(1, 200), wave(2, 5), wave(3, 5), wave(4, 5)], remember_s=500.0)
    assert state_rows(spark, f"{tmp_path}/cp") <= 10


def test_dispatches_are_those_of_the_state_table_plan(spark, tmp_path):
    """Three runs in event time with a dispatch fed back after each; the same as ``resolve_now`` over tables at the same times."""
    wait, log, clock = 100.0, CommitLog(spark, f"file://{tmp_path}/log"), [0.0]
    inbox, marks, sent, asked, done = f"{tmp_path}/in", f"{tmp_path}/marks", [], [], []
    os.makedirs(f"{marks}/none")
    plan = {10.0: ([("a", 3), ("b", 1), ("c", 2)], []), 60.0: ([("d", 0)], ["b"]), 150.0: ([("e", 9)], []), 400.0: ([], ["d"])}
    for now, (asks, finished) in plan.items():
        asked, done, clock[0] = asked + asks, done + finished, now + 0.5  # a mark is later than what it answers
        write(spark, inbox, [(i, "ask", o, now) for i, o in asks] + [(i, "done", None, now) for i in finished] + [("tick", "tick", None, now)])
        both = spark.readStream.schema(SCHEMA).parquet(inbox).unionByName(spark.readStream.schema(SCHEMA).parquet(f"{marks}/*"))
        before = {r.id: r.n for r in log.snapshot().table("sent").where("at is not null").groupBy("id").count().withColumnRenamed("count", "n").collect()} if log.versions() else {}
        # An id known only by its tick has its watermark moved; the timers that passed fire in the batch after it.
        resolve(both, log, marks, f"{tmp_path}/cp", lambda: 0, lambda: clock[0], high_water=50, batch=20, wait_s=wait, remember_s=None, event_time=True)
        after = {r.id: r.n for r in log.snapshot().table("sent").where("at is not null").groupBy("id").count().withColumnRenamed("count", "n").collect()}
        got = sorted(i for i in after if after[i] > before.get(i, 0))
        want = resolve_now(spark.createDataFrame(asked, "id string, ord long"), spark.createDataFrame(sent, "id string, ts double"), spark.createDataFrame([(i,) for i in done], "id string"), now, 0, wait=wait)
        want = sorted(r.id for r in want.collect())
        assert got == want, now
        sent += [(i, now + 0.5) for i in want]
    assert len(sent) > 6


def test_admission_by_order_below_the_high_water_mark(spark, tmp_path):
    log, marks, seen = CommitLog(spark, f"file://{tmp_path}/log"), f"{tmp_path}/marks", set()
    rows, sent = [(f"i{k}", "ask", 100 - k, 1.0) for k in range(9)], []
    for k, depth in enumerate([48, 50, 0, 0]):
        write(spark, f"{tmp_path}/in", rows if k == 0 else [("none", "tick", None, 1.0)])
        if k == 2:  # another writer between two runs
            log.commit(lambda s: {"waiting": Change(s.table("waiting"), "replace")})
        stream, depths = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), iter([depth])
        resolve(stream, log, marks, f"{tmp_path}/cp", lambda depths=depths: next(depths, 50), lambda: 5.0, batch=4, compact_every=2)
        new = {b for b in os.listdir(marks)} - seen
        seen |= new
        sent.append(sorted(r.id for b in new for r in spark.read.parquet(f"{marks}/{b}").collect()))
    assert sent == [["i7", "i8"], [], ["i3", "i4", "i5", "i6"], ["i0", "i1", "i2"]]
    log.commit(lambda s: cut_down(s, 10**6))
    assert log.snapshot().table("waiting").count() == log.snapshot().table("sent").count() == 0


def test_processing_time_timers_send_again(spark, tmp_path):
    log, inbox, marks = CommitLog(spark, f"file://{tmp_path}/log"), f"{tmp_path}/in", f"{tmp_path}/marks"
    os.makedirs(f"{marks}/none")
    write(spark, inbox, [("a", "ask", 1, None), ("b", "ask", 2, None)])

    def run():
        both = spark.readStream.schema(SCHEMA).parquet(inbox).unionByName(spark.readStream.schema(SCHEMA).parquet(f"{marks}/*"))
        resolve(both, log, marks, f"{tmp_path}/cp", lambda: 0, time.time, wait_s=2.0, most=3)

    run()  # both dispatched
    write(spark, inbox, [("b", "done", None, None)])
    run()  # the marks come back, b is done
    time.sleep(2.5)
    write(spark, inbox, [("tick", "tick", None, None)])
    run()  # a's timer
    got = sorted((r.id, r.try_no) for r in log.snapshot().table("sent").where("at is not null").collect())
    assert got == [("a", 0), ("a", 1), ("b", 0)]
