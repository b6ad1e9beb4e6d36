"""Operators on tiny frames: ties, nulls, repeats, resume, shards, streams."""

import pytest
from pyspark.sql import functions as F

from framequarry import models, schemas
from framequarry.operators import dedup, frames, joins, ledger, route, shard
from framequarry.plans import frames as frame_plan
from framequarry.plans import overlay, publish
from framequarry.sinks import writers
from framequarry.sources import readers
from framequarry.streaming import queries as streams


def test_sharpest_ties_and_last_window(spark):
    rows = [("a", 0, 0.0, 5.0), ("a", 1, 0.2, 5.0), ("a", 2, 1.9, 1.0), ("a", 10, 4.0, 2.0), ("b", 0, 0.0, 1.0)]
    got = frames.sharpest(spark.createDataFrame(rows, schemas.CANDIDATES), "video_id", F.col("t"), "cand_idx", "score", 2.0).orderBy("video_id", "frame_index").collect()
    assert [(r.video_id, r.ord, r.t, r.frame_index) for r in got] == [("a", 0, 0.0, 1), ("a", 10, 4.0, 2), ("b", 0, 0.0, 1)]


def test_extract_joins_playlist(spark):
    cand = spark.createDataFrame([("a", 0, 0.0, 5.0), ("b", 3, 0.6, 1.0)], schemas.CANDIDATES)
    play = spark.createDataFrame([("a", 5, "T", None)], schemas.PLAYLIST)
    got = frame_plan.extract(cand, play).orderBy("video_id").collect()
    assert [(r.image_id, r.video_title, r.video_url) for r in got] == [("a_f000001", "T", "https://www.youtube.com/watch?v=a"), ("b_f000001", None, "https://www.youtube.com/watch?v=b")]


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 5, None)], "k int, o int, v string")
    assert sorted((r.k, r.v) for r in dedup.keep_first(df, ["k"], ["o"]).collect()) == [(1, "x"), (2, None)]
    assert sorted((r.k, r.v) for r in dedup.last_wins(df, ["k"], ["o"]).collect()) == [(1, "y"), (2, None)]


def test_todo_retries_errors(spark):
    df = spark.createDataFrame([(" a",), ("b",), ("c",)], "image_id string")
    done = spark.createDataFrame([("a", None), ("b", "x")], "image_id string, error string")
    assert sorted(r.image_id for r in joins.todo(df, done, "image_id").collect()) == ["b", "c"]
    assert [r.image_id for r in joins.todo(df, done, "image_id", retry_errors=False).collect()] == ["c"]


def test_cleans_apply_to_all_rows_at_once(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "i int, caption string")
    flags = spark.createDataFrame([("a", 1), ("b", 1)], schemas.FLAGS)
    cleans = spark.createDataFrame([("a", "b")], schemas.CLEANS)
    assert sorted((r.i, r.caption) for r in joins.apply_cleans(df, flags, cleans).collect()) == [(1, "b"), (2, "b"), (3, "b"), (4, None)]


def test_merge_descriptions(spark):
    meta = spark.createDataFrame([("a", "c", 1), ("b", "d", 2)], "image_id string, caption string, z int")
    desc = spark.createDataFrame([("a ", None, "old", 1), ("a", "new", None, 2), ("a", "", None, 3), ("b", "", "", 1)], "image_id string, descriptive_text string, prompt_text string, ord int")
    out = joins.merge_descriptions(meta, desc)
    assert out.columns == ["image_id", "caption", "descriptive_text", "z"]
    assert sorted((r.image_id, r.descriptive_text) for r in out.collect()) == [("a", "new"), ("b", None)]


def test_routes_and_report(spark):
    df = spark.createDataFrame([(True, None), (False, None), (None, None), (False, "e")], "drop boolean, error string")
    assert [r.x for r in df.select(route.route_of(F.col("drop"), F.col("error")).alias("x")).collect()] == ["DROP", "KEEP", "ERROR", "ERROR"]
    status = spark.createDataFrame([("KEEP",), ("DROP",), (None,)], "filter_status string")
    r = route.final_report(status, status.limit(1)).first()
    assert (r.total, r.keep, r["drop"], r.unclear, r.keep_pct, r.status) == (3, 1, 1, 1, 33.3, "OK")
    assert route.funnel(status.limit(0)).first().keep_pct == 0


def test_size_mismatch(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), ("z", 0), ("n", None)], "name string, size long")
    b = spark.createDataFrame([("x", 1), ("y", 3)], "name string, size long")
    assert sorted(r.name for r in joins.size_mismatch(a, b).collect()) == ["n", "y"]


def test_alignment_needs_whole_batches(spark):
    req = spark.createDataFrame([(b, i) for b in range(4) for i in range(2)], "batch int, i int")
    rep = spark.createDataFrame([(0, 0, "a"), (0, 1, "b"), (1, 0, "a"), (2, 0, "a"), (2, 0, "b"), (3, 0, "a"), (3, 2, "b")], "batch int, i int, v string")
    assert [(r.batch, r.v) for r in joins.aligned(req, rep).orderBy("i").collect()] == [(0, "a"), (0, "b")]


@pytest.mark.parametrize("n, shards", [(10, 3), (2, 5), (0, 3), (1000, 7)])
def test_ceil_shards_cover(spark, n, shards):
    got = sorted((r.id, r.shard) for r in shard.ceil_shards(spark.range(n), "id", shards).collect())
    per = max(1, -(-n // shards))
    assert got == [(i, i // per) for i in range(n)]


def test_numbering_of_text_and_null_keys(spark):
    names = [f"n{i % 97:03d}/{i}" for i in range(500)] + ["é", "", "zz"]
    got = {r.k: r.pos for r in shard.numbered(spark.createDataFrame([(x,) for x in names], "k string"), "k").collect()}
    assert [k for k, _ in sorted(got.items(), key=lambda x: x[1])] == sorted(names) and sorted(got.values()) == list(range(len(names)))
    got = shard.numbered(spark.createDataFrame([(5,), (None,), (1,)], "k long"), "k").orderBy("pos").collect()
    assert [(r.k, r.pos) for r in got] == [(None, 0), (1, 1), (5, 2)]


def test_sample_is_stable(spark):
    a = {r.id for r in shard.seeded_sample(spark.range(100), "id", 10, 3).collect()}
    assert a == {r.id for r in shard.seeded_sample(spark.range(100).repartition(7), "id", 10, 3).collect()} and len(a) == 10
    assert shard.pick(spark.range(100), "id", sample=50, limit=5, seed=1, shard=(0, 2)).count() == 5


def test_ledgers(spark):
    a, b = spark.createDataFrame([("x",), ("y",), ("x",)], "id string"), spark.createDataFrame([("y",)], "id string")
    assert [r.id for r in ledger.missing(a, b).collect()] == ["x"]
    assert ledger.union_distinct(a, b).count() == 2 and ledger.requeue(a, b).count() == 1
    assert ledger.union_reports([None, a]).count() == 3
    with pytest.raises(ValueError):
        ledger.union_reports([None])


def test_sources(spark, tmp_path):
    k = "dQw4w9WgXcQ"
    (tmp_path / "u.txt").write_text(f"# c\n\n{k}\nhttps://youtu.be/{k}\nhttps://a/watch?v=abcdefghijk\n")
    assert [r.id for r in readers.url_list(spark, str(tmp_path / "u.txt")).orderBy("ord").collect()] == [k, "abcdefghijk"]
    (tmp_path / "l.txt").write_text("youtube a\nlonely\nyoutube a\nyoutube  b\n")
    assert sorted(r.id for r in readers.ledger(spark, str(tmp_path / "l.txt")).collect()) == ["a", "b"]
    (tmp_path / "p.tsv").write_text("id\tduration_seconds\ttitle\turl\na\t1\tT\t\na\t2\tU\tx\n")
    assert [(r.title, r.url) for r in readers.playlist(spark, str(tmp_path / "p.tsv")).collect()] == [("U", "x")]
    (tmp_path / "j.jsonl").write_text('{"caption": "a", "flag": 1}\nbad\n{"caption": "a", "flag": 0}\n')
    assert [(r.caption, r.flag) for r in readers.jsonl_map(spark, str(tmp_path / "j.jsonl"), "caption", "flag", schemas.FLAGS).collect()] == [("a", 0)]
    with pytest.raises(Exception):
        readers.jsonl(spark, str(tmp_path / "j.jsonl"), schemas.FLAGS).collect()
    (tmp_path / "a.json").write_text('{"x": 1.5}')
    assert [tuple(r) for r in readers.attempts(spark, str(tmp_path / "a.json")).collect()] == [("x", 1.5)]
    assert readers.attempts(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "m").mkdir()
    for n in ("a.done", "b.failed", ".c.done"):
        (tmp_path / "m" / n).write_text("")
    assert sorted(tuple(r) for r in readers.status_table(spark, str(tmp_path / "m")).collect()) == [("a", "done"), ("b", "failed")]
    (tmp_path / "c.toml").write_text("batch = 7\nodd = 1\n")
    assert readers.config(str(tmp_path / "c.toml"), {"batch": 1, "name": "n"}, overrides={"name": "z", "batch": None}) == {"batch": 7, "name": "z"}


def test_sinks(spark, tmp_path):
    a = spark.createDataFrame([(1, "old")], "k int, v string")
    b = spark.createDataFrame([(1, "new"), (2, "new")], "k int, v string")
    assert sorted(tuple(r) for r in writers.upsert(a, b, "k", str(tmp_path / "v1")).collect()) == [(1, "old"), (2, "new")]
    writers.write_images(spark.createDataFrame([("a.jpg", b"x")], "name string, bytes binary"), str(tmp_path / "img"))
    assert (tmp_path / "img" / "a.jpg").read_bytes() == b"x"
    assert readers.image_bytes(spark, str(tmp_path / "img")).first().bytes == b"x"
    n = writers.write_shards(spark.range(5).withColumnRenamed("id", "k"), "k", 4, str(tmp_path / "s"))
    assert sorted((r.shard_name, r.n) for r in n.collect()) == [("train-00000-of-00004", 2), ("train-00001-of-00004", 2), ("train-00002-of-00004", 1)]
    writers.write_lines(b, "v", str(tmp_path / "t"))
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["new"]


def test_model_ladder():
    def odd(texts):
        if len(texts) > 1:
            raise RuntimeError("too many")
        return [None if texts[0] == "bad" else texts[0].upper()]

    assert models.ladder(odd, ["a", "bad"]) == [("A", None), (None, "no reply")]


def test_pipeline_end_to_end(spark, tmp_path):
    cand = spark.createDataFrame([(f"video{v:06d}", i, i / 5, float((i * 7 + v) % 11)) for v in range(3) for i in range(40)], schemas.CANDIDATES)
    table = frame_plan.extract(cand, spark.createDataFrame([], schemas.PLAYLIST)).cache()
    assert table.count() == 12 and frame_plan.video_status(cand, table).where("status = 'done'").count() == 3
    done = frame_plan.classify(table.limit(5)).cache()
    rest = frame_plan.classify(table, done)
    everything = done.unionByName(rest).cache()
    assert everything.count() == 12 and everything.select("image_id").distinct().count() == 12
    kept = frame_plan.consolidate(table, everything)
    assert kept.count() == everything.where("filter_status = 'KEEP'").count()
    det = overlay.detect(table).cache()
    pics = table.select(F.col("image_filename").alias("name"), F.lit(bytes(20 * 30 * 3)).alias("bytes"), F.lit(20).alias("h"), F.lit(30).alias("w"))
    m = overlay.masks(det, pics)
    painted = overlay.inpaint(pics, m)
    final = overlay.assemble(overlay.refine(det, pics), pics.select("name"), painted.select("name")).cache()
    assert final.count() == det.where("not drop").count() and final.columns == schemas.FINAL.names
    described = publish.describe(final).withColumn("ord", F.lit(1))
    merged = joins.merge_descriptions(final, described)
    cleaned = publish.clean(merged, "caption", str(tmp_path / "c"), "frame")
    rows = publish.shard_rows(cleaned, pics)
    assert rows.columns == [f.name for f in schemas.SHARD.fields] and rows.count() == final.count()
    fixed, counts = publish.fix_composites(cleaned, lambda c: F.lit("plain"), "frame")
    assert counts.first().after == 0


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"2024-01-0{1 + i % 4} 00:{i % 60:02d}:00", i % 3, float(i * 37 % 101)) for i in range(200)]
    df = spark.createDataFrame(rows, "event_id long, t string, user_id long, value double").select("event_id", F.to_timestamp("t").alias("ts"), "user_id", "value")
    df.write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    streams.drain(streams.sharpest_stream(src, "user_id", "ts", "event_id", "value", "1 day"), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {(r.video_id, str(r.window_start)): r.ord for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = frames.sharpest(df, "user_id", F.unix_micros("ts") / 1e6, "event_id", "value", 86400.0).collect()
    assert len(got) == 9 and set(got.values()) <= {r.ord for r in batch}


def test_attempt_state_and_upsert_stream(spark, tmp_path):
    (tmp_path / "q").mkdir()
    for i in range(4):
        (tmp_path / "q" / f"id{i % 2}-{i}.url").write_text(f"https://x/{i}\n")
    q = readers.queue_stream(spark, str(tmp_path / "q"), 2)
    streams.upsert_stream(q, "id", str(tmp_path / "v"), str(tmp_path / "cp1"))
    assert spark.read.parquet(str(tmp_path / "v" / "v1")).count() == 4
    counts = streams.count_attempts(q.select(F.split("id", "-")[0].alias("id")), 2)
    counts.writeStream.format("memory").queryName("tries").outputMode("update").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start().awaitTermination()
    assert spark.table("tries").groupBy("id").agg(F.max("tries").alias("t")).where("t = 2").count() == 2


def test_flatten_audit_and_cli(spark, tmp_path):
    from framequarry import cli

    files = spark.createDataFrame([("b/x.jpg", "x.jpg", 2), ("a/x.jpg", "x.jpg", 1)], "path string, name string, size long")
    assert [tuple(r) for r in dedup.flatten(files, "frames").collect()] == [("a/x.jpg", "x.jpg", 1, "frames/x.jpg")]
    status = spark.createDataFrame([(i, "KEEP" if i % 2 else "DROP") for i in range(50)], "image_id int, filter_status string")
    assert route.audit(status, "image_id", 5, 3).groupBy("filter_status").count().where("count in (5, 3)").count() == 2
    assert route.throughput(status, 0.0, 10.0, 100).first().eta_seconds == 10.0
    assert cli.main(["init", str(tmp_path / "p")]) == 0 and (tmp_path / "p" / "framequarry.toml").exists()
    assert readers.config(str(tmp_path / "p" / "framequarry.toml"), cli.DEFAULTS) == cli.DEFAULTS
    assert cli.main(["run", "completion_barrier", "/root/testdata/sf0.001", "--out", str(tmp_path / "o")]) == 0
