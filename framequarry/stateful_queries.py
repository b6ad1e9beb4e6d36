"""Queries over the commit log, keyed state and claims, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from framequarry.operators import shard
from framequarry.queries import DAY, query, read, seconds
from framequarry.scratch import Scratch
from framequarry.sinks.commits import Change, CommitLog
from framequarry.streaming import claims, once, resolver

_WEEK = "user_id || '_' || cast(floor(epoch_us(ts) / 1e6 / 604800) as bigint)"


def _events(spark, d):
    week = F.concat(F.col("user_id").cast("string"), F.lit("_"), F.floor(seconds() / (7 * DAY)).cast("string"))
    return read(spark, d, "events").select(week.alias("k"), "event_id", "event_type", "value")


def _arrivals(rows, batch, folder):
    """A stream of ``rows`` in four batches by ``batch``, 0 to 3. The source takes so many files at a time, by age; so each batch is
    written by ``n`` tasks as ``n`` files, with a filler in each that the stream leaves out, as a task without rows writes no file."""
    spark = rows.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    fillers = spark.range(n).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema), F.col("id").cast("int").alias("fq_file"), F.lit(True).alias("fq_filler"))
    for k in range(4):
        mine = rows.where(batch == k).select("*", F.pmod(F.xxhash64(*rows.columns), F.lit(n)).cast("int").alias("fq_file"), F.lit(False).alias("fq_filler"))
        mine.unionByName(fillers).repartitionById(n, "fq_file").drop("fq_file").write.mode("append").parquet(folder)
    stream = spark.readStream.schema(rows.withColumn("fq_filler", F.lit(False)).schema).option("maxFilesPerTrigger", n).parquet(folder)
    return stream.where(~F.col("fq_filler")).drop("fq_filler")


@query(f"""with e as (select {_WEEK} as k, event_id, event_type, value, case event_type when 'view' then 1 when 'click' then 2 when 'purchase' then 3 end as p from events where event_type in ('view', 'click', 'purchase'))
 select k, event_id, event_type, value, p as version, 'done ' || k as status from (select *, row_number() over (partition by k order by p, event_id) as rn from e) where rn = 1""")
def commit_log_upsert(spark, d):
    """Three writers one after the other, each with a keep-first upsert of frames and the status of the new ones in one commit."""
    log = CommitLog(spark, f"{Scratch(spark).root}/log")
    for version, kind in enumerate(("view", "click", "purchase"), 1):
        rows = _events(spark, d).where(F.col("event_type") == kind).withColumn("version", F.lit(version))

        def build(s, rows=rows):
            new = s.unseen("frames", rows, "k", "event_id")
            return {"frames": Change(new), "status": Change(new.select("k", F.concat(F.lit("done "), "k").alias("status")))}

        log.commit(build, reads=("frames",))
    now = log.snapshot()
    return now.table("frames").join(now.table("status"), "k", "full_outer").select("k", "event_id", "event_type", "value", "version", "status")


_SIGNALS = """with recursive e as (select cast(user_id as varchar) as id, cast(user_id as bigint) as ord, event_type as kind, epoch_us(ts) / 1e6 as t from events where event_type in ('view', 'click', 'purchase') and not (event_type = 'purchase' and value < 80)),
 m as (select max(epoch_us(ts)) / 1e6 as last from events),
 a as (select id, any_value(ord) as ord, min(t) as t0 from e where kind = 'view' group by id),
 f as (select a.* from a where not exists (select 1 from e where e.id = a.id and e.kind = 'purchase' and e.t <= a.t0)),
 dn as (select f.id, coalesce(min(e.t), 1e300) as over from f left join e on e.id = f.id and e.kind = 'purchase' group by f.id),
 w(id, ord, k, t) as (select id, ord, 0, t0 from f union all
  select w.id, any_value(w.ord), any_value(w.k) + 1, min(e.t) + 86400 from w join e on e.id = w.id and e.kind = 'click' and (e.t > w.t or (w.k > 0 and e.t = w.t)) join dn on dn.id = w.id, m
  group by w.id having any_value(w.k) < 2 and min(e.t) < any_value(over) and min(e.t) + 86400 <= any_value(over) and min(e.t) + 86400 <= any_value(last)),
 s as (select w.id, w.ord, w.k, min(e.t) as t from w left join e on e.id = w.id and e.kind = 'click' and (e.t > w.t or (w.k > 0 and e.t = w.t)) group by w.id, w.ord, w.k)
"""


@query(f"""{_SIGNALS} select id, ord, cast(k as int) as try_no, round(t, 3) as t, 'due' as signal from w
 union all select s.id, s.ord, 3, round(s.t, 3), 'given_up' from s join dn using (id) where s.k = 2 and s.t < over
 union all select s.id, s.ord, cast(s.k as int), round(over, 3), 'withdrawn' from s join dn using (id) where over < 1e300 and (s.t is null or s.t >= over)""")
def resolver_state(spark, d):
    """All events replayed in four batches: views ask for their user, clicks are dispatches, large purchases end it; due again after a day, three times at most."""
    scratch = Scratch(spark)
    kind = F.when(F.col("event_type") == "view", "ask").when(F.col("event_type") == "click", "sent").when((F.col("event_type") == "purchase") & (F.col("value") >= 80), "done").otherwise("tick")
    rows = read(spark, d, "events").select(F.col("user_id").cast("string").alias("id"), kind.alias("kind"), F.col("user_id").cast("long").alias("ord"), seconds().alias("ts"))
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    quarter = F.least(F.floor((F.col("ts") - first) / ((last - first) / 4 + 1e-6)), F.lit(3))
    stream = _arrivals(rows, quarter, f"{scratch.root}/in")
    out = resolver.due_signals(stream, wait_s=DAY, most=3, remember_s=None, event_time=True).writeStream.format("parquet").option("path", f"{scratch.root}/out")
    out.option("checkpointLocation", f"{scratch.root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(resolver.SIGNAL).parquet(f"{scratch.root}/out").select("id", "ord", "try_no", F.round("at", 3).alias("t"), "signal")


@query(f"select {_WEEK} as k, min(event_id % 4) as batch from events group by 1")
def stream_once(spark, d):
    """Events in four batches by id modulo 4: every user and week is worked on once, in the first batch that has it."""
    scratch = Scratch(spark)
    rows = _events(spark, d).select("k", F.col("event_id") % 4)
    rows = rows.toDF("k", "batch")
    stream = _arrivals(rows, F.col("batch"), f"{scratch.root}/in")
    once.once_stream(stream, "k", f"{scratch.root}/out", f"{scratch.root}/state", lambda new: new, buckets=8)
    return spark.read.parquet(*(f"{scratch.root}/out/b{k}" for k in range(4)))


@query("""with q as (select cast(doc_id as varchar) as id, row_number() over (order by doc_id) - 1 as pos, count(*) over () as n, doc_id from documents)
 select id, case when pos < n * 2 // 5 and doc_id % 2 = 0 then 'one' else 'two' end as worker, cast(case when pos < n * 2 // 5 and doc_id % 2 = 1 then 2 else 1 end as bigint) as claims from q""")
def claims_lease(spark, d):
    """Two workers: the first takes two fifths of the documents, brings half of these back and is lost; the second takes what is open
    after the lease. What the first brings then is refused."""
    queue = read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("doc_id").alias("ord"))
    log, n = CommitLog(spark, f"{Scratch(spark).root}/log"), queue.count()
    desk = claims.Claims(log, queue, lease_s=60.0, in_flight=n)

    def done(got, worker):
        return got.select("id", F.lit(worker).alias("worker"))

    one = desk.take("one", n * 2 // 5, 0.0)
    name_one = one.select("claim").first()
    even = one.where(F.col("id").cast("long") % 2 == 0)
    if name_one:
        desk.finish(name_one[0], done(even, "one"), 30.0)
    two = desk.take("two", n, 61.0)
    if name_one:
        desk.finish(name_one[0], done(one, "one"), 62.0)
    if name_two := two.select("claim").first():
        desk.finish(name_two[0], done(two, "two"), 63.0)
    s = log.snapshot()
    count = s.table("claims").groupBy("id").agg(F.count("*").alias("claims"))
    return s.table("results").join(count, "id").select("id", "worker", "claims")


@query("""with s as (select doc_id, strlen(text) + 1 as size, sum(strlen(text) + 1) over (order by doc_id) as upto, sum(strlen(text) + 1) over () as total from documents)
 select doc_id, cast(size as bigint) as size, cast(upto as bigint) as upto from s where upto <= total * 2 // 5""")
def admit_bytes(spark, d):
    """Documents in order while their bytes fit into two fifths of all bytes."""
    rows = read(spark, d, "documents").select("doc_id", (F.octet_length("text") + 1).cast("long").alias("size"))
    room = (rows.agg(F.sum("size")).first()[0] or 0) * 2 // 5
    return shard.admit_weight(rows, "doc_id", "size", room, name="upto")
