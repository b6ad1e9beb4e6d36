"""Answers that once were wrong, and parts that had no test."""

import json

import pytest
from pyspark.sql import functions as F

from framequarry import models, schemas
from framequarry.functions import text
from framequarry.operators import joins, route, shard
from framequarry.plans import publish
from framequarry.scratch import Scratch
from framequarry.sinks import writers
from framequarry.sources import readers
from framequarry.streaming import once
from framequarry.streaming import queries as streams


def test_last_wins_follows_the_order_of_files(spark, tmp_path):
    (tmp_path / "part-0.jsonl").write_text('{"caption": "a", "flag": 0}\n')
    (tmp_path / "part-1.jsonl").write_text('{"caption": "b", "flag": 0}\n' * 5000 + '{"caption": "a", "flag": 1}\n')
    got = {r.caption: r.flag for r in readers.jsonl_map(spark, str(tmp_path), "caption", "flag", schemas.FLAGS).collect()}
    assert got == {"a": 1, "b": 0}
    lines = [r.line for r in readers.lines(spark, str(tmp_path)).orderBy("ord").collect()]
    assert "0" in lines[0] and lines[0].count("a") and lines[-1] == '{"caption": "a", "flag": 1}'


def test_truth_of_json(spark):
    values = ["[]", "{}", "x", "", "false", [], {}, [0], {"a": 0}, 0, 0.5, False, True, None]
    df = spark.createDataFrame([(i, json.dumps({"v": v})) for i, v in enumerate(values)], "i int, t string")
    got = [r.x for r in df.select("i", text.truthy(text.json_variant(F.col("t")), "$.v").alias("x")).orderBy("i").collect()]
    assert got == [bool(v) for v in values]


def test_positions_of_keys_with_a_long_common_start(spark):
    names = [f"https://a.long.host.example/{i:07d}" for i in range(3000)]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "k string").repartition(37)
    got = {r.k: r.pos for r in shard.numbered(df, "k").collect()}
    assert [got[n] for n in names] == list(range(3000))
    assert shard.numbered(df.limit(0), "k").count() == 0


def test_state_goes_after_giving_up(spark, tmp_path):
    (tmp_path / "q").mkdir()
    q = readers.queue_stream(spark, str(tmp_path / "q"), 1)
    counts = streams.count_attempts(q.select(F.split("id", "-")[0].alias("id")), 2)
    for i in range(3):
        (tmp_path / "q" / f"x-{i}.url").write_text("u\n")
    counts.writeStream.format("memory").queryName("given_up").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.tries, r.given_up) for r in spark.table("given_up").collect()) == [(1, False), (1, False), (2, True)]


def test_upsert_stream_keeps_two_versions(spark, tmp_path):
    (tmp_path / "q").mkdir()
    for i in range(4):
        (tmp_path / "q" / f"id{i}.url").write_text("u\n")
    streams.upsert_stream(readers.queue_stream(spark, str(tmp_path / "q"), 1), "id", str(tmp_path / "v"), str(tmp_path / "cp"))
    assert sorted(p.name for p in (tmp_path / "v").iterdir()) == ["v2", "v3"] and spark.read.parquet(str(tmp_path / "v" / "v3")).count() == 4


def test_resolver_and_classifier_streams(spark, tmp_path):
    (tmp_path / "q").mkdir()
    for i in range(4):
        (tmp_path / "q" / f"id{i}.url").write_text("u\n")
    q = readers.queue_stream(spark, str(tmp_path / "q"), 2)
    done = spark.createDataFrame([("id1",)], "id string")
    streams.resolver_stream(q.select("id", F.substring("id", 3, 9).cast("int").alias("ord")), done, str(tmp_path / "r"), str(tmp_path / "cp1"), lambda: 1000.0, lambda: 0, batch=2)
    sent = [r.id for n in (0, 1) for r in spark.read.parquet(str(tmp_path / "r" / f"d{n}")).orderBy("ord").collect()]
    assert "id1" not in sent and sorted(sent) == ["id0", "id2", "id3"]
    once.classify_stream(q.select(F.col("id").alias("image_id")), str(tmp_path / "c"), str(tmp_path / "cp2"))
    assert spark.read.parquet(str(tmp_path / "c" / "b0"), str(tmp_path / "c" / "b1")).count() == 4


def test_retry_waits_and_adds_usage():
    answers, waits = iter([(429, None, {"t": 1}), (503, None, {"t": 2}), (200, "ok", {"t": 3})]), []
    assert models.call_with_retry(lambda t: next(answers), "x", 4, waits.append) == ("ok", None, 200, 3, {"t": 6}) and waits == [1.0, 2.0]
    assert models.call_with_retry(lambda t: (403, None, {}), "x", 4, waits.append)[1:4] == ("HTTP 403", 403, 1)


def test_batches_that_lose_an_answer(spark):
    models.register("lossy", lambda: lambda requests: [json.dumps([{"i": x["i"], "v": x["text"].upper()} for x in json.loads(r)][: None if "a" in r else 1]) for r in requests])
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("a",), (None,)], "t string")
    assert sorted(tuple(r) for r in models.ask_batches(df, "t", "lossy", 2).collect()) == [("a", "A"), ("b", "B")]
    assert sorted(tuple(r) for r in models.ask_batches(df, "t", "lossy", 2, whole=False).collect()) == [("a", "A"), ("b", "B"), ("c", "C")]
    models.register("loud", models.indexed(lambda: lambda texts: [t.replace("logo", "mark") if t != "logo z" else "" for t in texts]))
    rows = spark.createDataFrame([(1, "logo x"), (2, "logo x"), (3, "logo z"), (4, "plain")], "i int, caption string")
    out, counts, left = publish.fix_composites_in_batches(rows, "loud", "logo")
    assert sorted((r.i, r.caption) for r in out.collect()) == [(1, "mark x"), (2, "mark x"), (3, "logo z"), (4, "plain")]
    assert tuple(counts.first()) == (3, 1) and [r.caption for r in left.collect()] == ["logo z"]


def test_sources_and_sinks_without_a_test_so_far(spark, tmp_path):
    (tmp_path / "f").mkdir()
    for n, body in (("a.mp4", "12345"), (".b.mp4", "1"), ("c.mp4.part", "1"), ("d.txt", "x")):
        (tmp_path / "f" / n).write_text(body)
    assert [(r.name, r.size) for r in readers.listing(spark, str(tmp_path / "f"), "*").orderBy("name").collect()] == [("a.mp4", 5), ("d.txt", 1)]
    df = spark.createDataFrame([("a", 'x "q"\ny'), ("b", "z")], "id string, t string")
    writers.write_both(df, str(tmp_path / "m"))
    assert sorted(tuple(r) for r in readers.csv_table(spark, str(tmp_path / "m" / "metadata.csv"), df.schema).collect()) == sorted(tuple(r) for r in df.collect())
    assert readers.csv_strings(spark, str(tmp_path / "m" / "metadata.csv")).count() == spark.read.parquet(str(tmp_path / "m" / "metadata.parquet")).count() == 2
    writers.append_jsonl(df, str(tmp_path / "j"))
    writers.append_jsonl(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 4
    writers.rewrite_jsonl(df, str(tmp_path / "j"))
    assert readers.known_ids(spark.read.json(str(tmp_path / "j")), df).count() == 2
    writers.route(df.withColumn("filter_status", F.lit("KEEP")), str(tmp_path / "r"))
    assert (tmp_path / "r" / "filter_status=KEEP").is_dir()
    writers.write_report(df, str(tmp_path / "rep"), "shard0")
    assert (tmp_path / "rep" / "shard0.done").exists() and spark.read.csv(str(tmp_path / "rep" / "shard0.csv"), header=True, multiLine=True, escape='"').count() == 2
    (tmp_path / "ids.txt").write_text(" a \n\nb\na\n")
    assert sorted(r.id for r in readers.id_lines(spark, str(tmp_path / "ids.txt")).collect()) == ["a", "b"]
    assert writers.shard_files(spark.range(5).withColumnRenamed("id", "k"), "k", 4, str(tmp_path / "s")) == [f"train-0000{k}-of-00004.parquet" for k in range(3)]
    state = writers.state_upsert(spark.createDataFrame([("a", 1.0)], schemas.ATTEMPTS), spark.createDataFrame([("a", 2.0), ("b", 1.0)], schemas.ATTEMPTS))
    assert sorted(tuple(r) for r in state.collect()) == [("a", 2.0), ("b", 1.0)]


def test_small_expressions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(text.first_http_line(F.lit("a\nhttp://b\nhttp://c"))) == "http://b"
    assert one(text.size_text(F.lit(3 << 29))) == "1.5 GB" and one(text.size_text(F.lit(12 << 20))) == "12.0 MB"
    assert one(text.date_text(F.to_timestamp(F.lit("2024-01-02 03:04:05")))) == "2024-01-02 03:04:05"
    probe = spark.createDataFrame([(10, 20, -90), (10, 20, None)], "w int, h int, rotation int")
    assert [(r.display_w, r.display_h) for r in readers.display_size(probe).collect()] == [(20, 10), (10, 20)]
    assert one(readers.valid_download(F.lit(0), F.lit(70_000), F.lit(True))) is True
    files = spark.createDataFrame([("a.jpg",)], "name string")
    frames = spark.createDataFrame([("a.jpg", False, None, "c"), ("b.jpg", False, None, " ")], "image_filename string, drop boolean, error string, caption string")
    assert joins.existing(frames, files).count() == route.clean_candidates(frames).count() == 1
    assert tuple(route.freed(spark.createDataFrame([("a", 5)], "id string, size long")).first()) == (1, 5)
    assert [tuple(r) for r in route.stage_status(a=files, b=frames).collect()] == [("a", 1), ("b", 2)]


def test_scratch_goes(spark, tmp_path):
    scratch = Scratch(spark)
    df = scratch.write(spark.range(3))
    assert df.count() == 3
    scratch.close()
    with pytest.raises(Exception):
        spark.read.parquet(f"{scratch.root}/t1").count()
