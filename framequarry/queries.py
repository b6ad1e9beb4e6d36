"""Queries of the reference's operators on the driver's tables, each with the SQL that says the same."""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry import models
from framequarry.functions import boxes, ids, images, retry, text
from framequarry.functions.areas import component_boxes
from framequarry.operators import dedup, frames, joins, ledger, route, shard
from framequarry.scratch import Scratch, shared_dir
from framequarry.sinks import writers
from framequarry.sources import readers
from framequarry.streaming import queries as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
DAY, KEYWORDS = 86400.0, "copyright|license|@|password|key"


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def seconds(ts: str = "ts"):
    """Seconds of a TIMESTAMP_NTZ since 1970 as a double."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {ts})") / 1e6


_SHARPEST = """select cast(user_id as varchar) as video_id, cast(floor(epoch_us(ts) / 1e6 / 86400) as bigint) as bucket, event_id as ord, value as score,
  row_number() over (partition by user_id order by floor(epoch_us(ts) / 1e6 / 86400)) as frame_index from (
    select *, row_number() over (partition by user_id, floor(epoch_us(ts) / 1e6 / 86400) order by value desc, ts, event_id) as rn from events) where rn = 1"""


def best_frames(spark: SparkSession, d: str) -> DataFrame:
    return frames.sharpest(read(spark, d, "events"), "user_id", seconds(), "event_id", "value", DAY)


@query(_SHARPEST)
def sharpest_per_window(spark, d):
    return best_frames(spark, d).select(F.col("video_id").cast("string").alias("video_id"), "bucket", "ord", "score", "frame_index")


@query(f"""with b as ({_SHARPEST}) select printf('%s_f%06d', video_id, frame_index) as image_id, printf('%s_f%06d.jpg', video_id, frame_index) as image_filename,
  c_name as video_title, coalesce(c_name, 'https://v.example/' || video_id) as video_url, score from b left join customer on video_id = cast(c_custkey as varchar)""")
def frames_with_dimension(spark, d):
    dim = read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("c"), "c_name")
    b = best_frames(spark, d).withColumn("video_id", F.col("video_id").cast("string")).join(dim, F.col("video_id") == F.col("c"), "left")
    return b.select(ids.image_id(F.col("video_id"), F.col("frame_index")).alias("image_id"), ids.image_filename(F.col("video_id"), F.col("frame_index")).alias("image_filename"), F.col("c_name").alias("video_title"), ids.default_url(F.col("c_name"), F.col("video_id"), "https://v.example/").alias("video_url"), "score")


@query(r"""select page_id, nullif(regexp_extract(url, '/([0-9]+)[^/0-9]*$', 1), '') as page_no, nullif(regexp_extract(url, '^([A-Za-z0-9_-]{11})', 1), '') as file_id,
  split_part(split_part(url, ' ', 1), '.', 1) as host_head, coalesce(nullif(regexp_extract(url, '[?&]page=([^&?#/\s]+)', 1), ''), 'none') as page_param from pages""")
def url_id_extract(spark, d):
    u = F.col("url")
    return read(spark, d, "pages").select("page_id", F.nullif(F.regexp_extract(u, "/([0-9]+)[^/0-9]*$", 1), F.lit("")).alias("page_no"), ids.id_from_filename(u).alias("file_id"), ids.id_from_video_file(u).alias("host_head"), F.coalesce(F.nullif(F.regexp_extract(u, r"[?&]page=([^&?#/\s]+)", 1), F.lit("")), F.lit("none")).alias("page_param"))


@query("""with l as (select doc_id, substr(md5(cast(doc_id as varchar)), 1, 11) as k from documents),
 m as (select doc_id, k, case doc_id % 5 when 0 then k when 1 then 'https://x.example/watch?v=' || k || '&t=1' when 2 then 'https://youtu.be/' || k when 3 then 'https://x.example/shorts/' || k else 'no id' end as line from l)
 select doc_id, case when doc_id % 5 < 4 then k end as line_id, case when doc_id % 5 in (1, 2) then k end as url_id, k || '_f00' || cast(doc_id % 10 as varchar) as frame, k as frame_video from m""")
def id_forms(spark, d):
    k = F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 11)
    m = read(spark, d, "documents").select("doc_id", k.alias("k"))
    r = F.col("doc_id") % 5
    line = F.when(r == 0, F.col("k")).when(r == 1, F.concat(F.lit("https://x.example/watch?v="), "k", F.lit("&t=1"))).when(r == 2, F.concat(F.lit("https://youtu.be/"), "k")).when(r == 3, F.concat(F.lit("https://x.example/shorts/"), "k")).otherwise("no id")
    m = m.withColumns({"line": line, "frame": F.concat("k", F.lit("_f00"), (F.col("doc_id") % 10).cast("string"))})
    return m.select("doc_id", ids.id_from_line(F.col("line")).alias("line_id"), ids.id_from_url_loose(F.col("line")).alias("url_id"), "frame", ids.id_from_frame(F.concat("frame", F.lit(".jpg"))).alias("frame_video"))


@query("select text as t, min(doc_id) as first_seen, count(*) as n from documents group by text")
def first_seen_text(spark, d):
    return dedup.first_seen(read(spark, d, "documents").withColumnRenamed("text", "t"), "t", "doc_id")


@query(f"select lang, count(*) as total, count(*) filter (where regexp_matches(text, '{KEYWORDS}', 'i')) as hits, count(*) filter (where regexp_matches(replace(text, '@', ''), '{KEYWORDS}', 'i')) as left_over from documents group by lang")
def keyword_prefilter(spark, d):
    t = F.col("text")
    return read(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("total"), F.count_if(t.rlike(f"(?i){KEYWORDS}")).alias("hits"), F.count_if(F.replace(t, F.lit("@"), F.lit("")).rlike(f"(?i){KEYWORDS}")).alias("left_over"))


_REPLY = "case doc_id % 8 when 0 then 'YES.' when 1 then 'no' when 2 then 'None visible' when 3 then 'people' when 4 then '' when 5 then 'maybe' when 6 then '**No**' else 'farm, no crop' end"
_REPLY2 = "case doc_id % 5 when 0 then 'KEEP or DROP' when 1 then 'farm' when 2 then 'keep' when 3 then '' else 'crop field' end"


@query(f"""with r as (select doc_id, upper({_REPLY}) as u from labels) select doc_id, case when regexp_extract(u, '[A-Z]+', 0) = 'YES' or contains(u, 'PEOPLE') then 'DROP'
  when regexp_extract(u, '[A-Z]+', 0) = 'NO' or contains(u, 'NONE') then 'KEEP' else 'UNCLEAR' end as verdict from r""")
def verdict_yes_no(spark, d):
    return read(spark, d, "labels").select("doc_id", text.verdict_yes_no(F.expr(_REPLY)).alias("verdict"))


@query(f"""with r as (select doc_id, upper({_REPLY2}) as u from labels) select doc_id, case when contains(u, 'DROP') then 'DROP' when contains(u, 'KEEP') or contains(u, 'FARM') or contains(u, 'CROP') then 'KEEP' else 'DROP' end as verdict from r""")
def verdict_keep_drop(spark, d):
    return read(spark, d, "labels").select("doc_id", text.verdict_keep_drop(F.expr(_REPLY2)).alias("verdict"))


_MESSAGE = "case event_id % 6 when 0 then 'ERROR: Private video' when 1 then 'HTTP Error 429: too many requests' when 2 then 'Video unavailable, sign in to confirm' when 3 then 'timed out' when 4 then 'The following content is not available' else event_type end"


@query(f"""with m as (select event_type, {_MESSAGE} as m, event_id % 7 as s from events) select event_type, case when regexp_matches(m, '{text.PERMANENT}', 'i') then 'permanent' when regexp_matches(m, '{text.THROTTLED}', 'i') then 'throttled' else 'transient' end as error_class,
  count(*) as n, count(*) filter (where s + 499 in (429, 500, 502, 503, 504)) as retryable from m group by 1, 2""")
def error_class(spark, d):
    m = read(spark, d, "events").select("event_type", F.expr(_MESSAGE).alias("m"), (F.col("event_id") % 7 + 499).alias("s"))
    return m.groupBy("event_type", text.error_class(F.col("m")).alias("error_class")).agg(F.count("*").alias("n"), F.count_if(text.retryable(F.col("s"))).alias("retryable"))


@query("select doc_id, source from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def resume_todo(spark, d):
    return joins.todo(read(spark, d, "documents").select("doc_id", "source"), read(spark, d, "labels"), "doc_id")


@query("select doc_id, 'no_people/' || cast(doc_id as varchar) || '.jpg' as relative_path from documents d where exists (select 1 from labels l where l.doc_id = d.doc_id and quality = 1)")
def keep_semi_repoint(spark, d):
    keep = read(spark, d, "labels").where("quality = 1").select("doc_id")
    docs = read(spark, d, "documents").select("doc_id").join(keep, "doc_id", "left_semi")
    return docs.select("doc_id", ids.repoint("no_people", F.concat(F.col("doc_id").cast("string"), F.lit(".jpg"))).alias("relative_path"))


_ROUTED = "select d.doc_id, d.source, case when l.doc_id is null then 'ERROR' when quality = 0 then 'DROP' else 'KEEP' end as filter_status from documents d left join labels l on d.doc_id = l.doc_id"


def routed(spark, d):
    lab = read(spark, d, "labels").select(F.col("doc_id").alias("l"), "quality")
    both = read(spark, d, "documents").join(lab, F.col("doc_id") == F.col("l"), "left")
    return both.select("doc_id", "source", route.route_of(F.col("quality") == 0, F.lit(None)).alias("filter_status"))


@query(_ROUTED)
def status_route(spark, d):
    return routed(spark, d)


@query(f"""with r as ({_ROUTED}), a as (select count(*) as total, count(*) filter (where filter_status = 'KEEP') as keep, count(*) filter (where filter_status = 'DROP') as "drop", count(*) filter (where filter_status = 'ERROR') as unclear from r)
 select *, round(keep / greatest(1, total) * 100, 1) as keep_pct, round("drop" / greatest(1, total) * 100, 1) as drop_pct, (select count(*) from labels where quality = 1) as metadata_rows, case when keep = (select count(*) from labels where quality = 1) then 'OK' else 'MISMATCH' end as status from a""")
def funnel_report(spark, d):
    return route.final_report(routed(spark, d), read(spark, d, "labels").where("quality = 1"))


@query(f"select source, filter_status, count(*) as n from ({_ROUTED}) group by rollup (source, filter_status)")
def funnel_rollup(spark, d):
    return routed(spark, d).rollup("source", "filter_status").agg(F.count("*").alias("n"))


_FLAGS = "f as (select text, max(1 - quality) as flag from documents join labels using (doc_id) group by text), c as (select text, 'clean ' || md5(text) as clean from f where flag = 1 and length(text) % 5 > 0)"


def flags_and_cleans(spark, d):
    """Flags and rewrites by the digests of their texts."""
    text = F.col("text")
    known = read(spark, d, "documents").where("text is not null").select("doc_id", dedup.digest(text).alias("digest"), F.md5(text.cast("binary")).alias("md5"), F.length("text").alias("n"))
    f = known.join(read(spark, d, "labels"), "doc_id").groupBy("digest", "md5", "n").agg(F.max(1 - F.col("quality")).alias("flag"))
    return f.select("digest", "flag"), f.where("flag = 1 and n % 5 > 0").select("digest", F.concat(F.lit("clean "), "md5").alias("clean"))


@query(f"with {_FLAGS} select doc_id, md5(case when flag = 1 and coalesce(clean, '') <> '' then clean else d.text end) as text_md5 from documents d left join f on d.text = f.text left join c on d.text = c.text")
def clean_apply(spark, d):
    f, c = flags_and_cleans(spark, d)
    return joins.apply_cleans(read(spark, d, "documents").select("doc_id", "text"), f, c, "text").select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(f"""with {_FLAGS}, u as (select distinct text from documents where regexp_matches(text, '{KEYWORDS}', 'i')) select (select count(distinct text) from documents) as distinct_texts, (select count(*) from u) as prefiltered,
  (select count(*) from u join f using (text)) as flagged_before, (select count(*) from u anti join f using (text)) as to_classify, (select count(*) from f anti join c using (text) where flag = 1) as to_rewrite""")
def cascade_counts(spark, d):
    f, c = flags_and_cleans(spark, d)
    texts = read(spark, d, "documents").where("text is not null").select(dedup.digest(F.col("text")).alias("digest"), F.col("text").rlike(f"(?i){KEYWORDS}").alias("hit")).groupBy("digest").agg(F.max("hit").alias("hit"))
    u = texts.where("hit")
    one = lambda df, n: df.agg(F.count("*").alias(n))
    out = one(texts, "distinct_texts")
    for df, n in ((u, "prefiltered"), (u.join(f, "digest", "left_semi"), "flagged_before"), (u.join(f, "digest", "left_anti"), "to_classify"), (f.where("flag = 1").join(c, "digest", "left_anti"), "to_rewrite")):
        out = out.join(one(df, n))  # one row each
    return out


@query("""with l as (select conv_id, text as descriptive_text from (select *, row_number() over (partition by conv_id order by turn desc, role desc, text desc) as rn from conversations where text <> '') where rn = 1)
 select doc_id, md5(descriptive_text) as d_md5 from documents left join l on doc_id = conv_id""")
def merge_last_wins(spark, d):
    meta = read(spark, d, "documents").select("doc_id", F.col("source").alias("caption")).withColumnRenamed("doc_id", "image_id")
    desc = read(spark, d, "conversations").select(F.col("conv_id").alias("image_id"), F.col("text").alias("descriptive_text"), F.struct("turn", "role").alias("ord"))
    return joins.merge_descriptions(meta, desc).select(F.col("image_id").alias("doc_id"), F.md5(F.col("descriptive_text").cast("binary")).alias("d_md5"))


@query("select conv_id, count(*) as n, count(nullif(text, '')) as filled from conversations group by conv_id")
def fill_counts(spark, d):
    return read(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.count(F.nullif("text", F.lit(""))).alias("filled"))


@query("""select cast(d.doc_id as varchar) as image_id, 'images/' || cast(d.doc_id as varchar) || '.jpg' as relative_path, d.doc_id % 3 > 0 as had_overlay, d.doc_id % 2 = 0 as overlay_inpainted, cast(d.doc_id % 3 as int) as n_boxes
 from documents d join labels l on d.doc_id = l.doc_id where quality = 1 and (d.doc_id % 2 = 0 or exists (select 1 from pages p where p.page_id = d.doc_id))""")
def assemble_final(spark, d):
    det = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".jpg"))
    box = "transform(sequence(1, cast(doc_id % 3 as int)), i -> struct('logo' as label, array(0D, 0D, 1D, 1D) as box))"
    det = det.select("doc_id", F.col("doc_id").cast("string").alias("image_id"), name.alias("image_filename"), F.lit("").alias("video_id"), F.lit("").alias("video_title"), F.lit("").alias("video_url"), F.lit(0.0).alias("timestamp_seconds"), F.col("text").alias("caption"), (F.col("quality") == 0).alias("drop"), F.lit(None).cast("string").alias("error"), F.when(F.col("doc_id") % 3 > 0, F.expr(box)).alias("boxes"))
    originals = read(spark, d, "pages").select(F.concat(F.col("page_id").cast("string"), F.lit(".jpg")).alias("name"))
    inpainted = read(spark, d, "documents").where("doc_id % 2 = 0").select(F.concat(F.col("doc_id").cast("string"), F.lit(".png")).alias("name"))
    return joins.assemble(det, originals, inpainted).select("image_id", "relative_path", "had_overlay", "overlay_inpainted", F.col("n_boxes").cast("int").alias("n_boxes"))


_RAW_BOXES = """raw as (select vec_id, i, cast(label as varchar) as label, [1000 * e[4 * i + 1], 1000 * e[4 * i + 2], 1000 * e[4 * i + 1] + 400 * e[4 * i + 3], 1000 * e[4 * i + 2] + 400 * e[4 * i + 4]] as b
   from (select vec_id, label, cast(embedding as double[]) as e, unnest(range(0, 16)) as i from embeddings)),
 c as (select vec_id, i, label, list_transform(b, lambda x: greatest(0.0, least(1000.0, cast(x as double)))) as b from raw), v as (select * from c where b[3] > b[1] and b[4] > b[2])"""


def raw_boxes(spark, d):
    e = read(spark, d, "embeddings")
    b = "transform(sequence(0, 15), i -> struct(cast(label as string) as label, transform(array(1000 * e[4 * i], 1000 * e[4 * i + 1], 1000 * e[4 * i] + 400 * e[4 * i + 2], 1000 * e[4 * i + 1] + 400 * e[4 * i + 3]), x -> x) as box))"
    e = e.withColumn("e", F.col("embedding").cast("array<double>"))
    return e.select("vec_id", boxes.clamp(F.expr(b)).alias("boxes"))


@query(f"with {_RAW_BOXES} select vec_id, row_number() over (partition by vec_id order by i) - 1 as pos, label, round(b[1], 3) as ymin, round(b[2], 3) as xmin, round(b[3], 3) as ymax, round(b[4], 3) as xmax from v")
def box_normalise(spark, d):
    x = raw_boxes(spark, d).select("vec_id", F.posexplode("boxes").alias("pos", "b"))
    return x.select("vec_id", F.col("pos").cast("long").alias("pos"), F.col("b.label").alias("label"), *(F.round(F.col("b.box")[i], 3).alias(n) for i, n in enumerate(("ymin", "xmin", "ymax", "xmax"))))


@query(f"""with {_RAW_BOXES}, k as (select vec_id, i, label, list_transform(b, lambda x: round_even(x / 200, 0)) as k from v), one as (select *, row_number() over (partition by vec_id, label, k order by i) as rn from k)
 select vec_id, count(*) as n, cast(sum(k[1]) as bigint) as s from one where rn = 1 group by vec_id""")
def box_dedupe(spark, d):
    coarse = raw_boxes(spark, d).select("vec_id", F.transform("boxes", lambda b: F.struct(b["label"].alias("label"), F.transform(b["box"], lambda x: x / 200).alias("box"))).alias("boxes"))
    x = coarse.select("vec_id", F.explode(boxes.dedupe(F.col("boxes"))).alias("b"))
    return x.groupBy("vec_id").agg(F.count("*").alias("n"), F.sum(F.bround(F.col("b.box")[0], 0)).cast("long").alias("s"))


_PIXELS = f"""{_RAW_BOXES}, p as (select vec_id, i, greatest(0, cast(trunc(b[2] / 1000 * 64) as int) - 1) as x0, greatest(0, cast(trunc(b[1] / 1000 * 36) as int) - 1) as y0, least(64, cast(trunc(b[4] / 1000 * 64) as int) + 1) as x1, least(36, cast(trunc(b[3] / 1000 * 36) as int) + 1) as y1 from v),
 px as (select * from p where x1 > x0 and y1 > y0)"""


def pixel_boxes(spark, d):
    return raw_boxes(spark, d).select("vec_id", boxes.to_pixels(F.col("boxes"), F.lit(64), F.lit(36), 1).alias("px"))


@query(f"with {_PIXELS} select vec_id, x0, y0, x1, y1, count(*) as n from px group by all")
def box_to_pixels(spark, d):
    return pixel_boxes(spark, d).select("vec_id", F.inline("px")).groupBy("vec_id", "x0", "y0", "x1", "y1").agg(F.count("*").alias("n"))


@query(f"with {_PIXELS}, cells as (select vec_id, x, unnest(range(y0, least(35, y1) + 1)) as y from (select *, unnest(range(x0, least(63, x1) + 1)) as x from px)) select vec_id, cast(count(distinct 64 * y + x) as bigint) as area from cells group by vec_id")
def mask_area(spark, d):
    return pixel_boxes(spark, d).where(F.size("px") > 0).select("vec_id", images.mask_area(F.lit(36), F.lit(64), "px").alias("area"))


@query("""with g as (select vec_id, i, cast(embedding[i + 1] as double) as v from (select *, unnest(range(0, 64)) as i from embeddings)), n as (
  select a.vec_id, a.i, sum(b.v) - 4 * any_value(a.v) as lap from g a join (select 0 as k union all select 1 union all select 2 union all select 3) k on true join g b on b.vec_id = a.vec_id
   and b.i = case k when 0 then case when a.i < 8 then a.i else a.i - 8 end when 1 then case when a.i > 55 then a.i else a.i + 8 end when 2 then case when a.i % 8 = 0 then a.i else a.i - 1 end else case when a.i % 8 = 7 then a.i else a.i + 1 end end group by a.vec_id, a.i)
 select vec_id, round(var_pop(lap), 6) as sharpness from n group by vec_id""")
def sharpness_laplacian(spark, d):
    return read(spark, d, "embeddings").select("vec_id", F.round(images.grid_sharpness(F.col("embedding"), 8), 6).alias("sharpness"))


@query("""with q as (select vec_id, cast(floor(embedding[3 * i + 1] * 4) as int) as r, cast(floor(embedding[3 * i + 2] * 4) as int) as g, cast(floor(embedding[3 * i + 3] * 4) as int) as b from (select *, unnest(range(0, 21)) as i from embeddings)),
 n as (select vec_id, r, g, b, count(*) as n from q group by all) select vec_id, r, g, b, n from (select *, row_number() over (partition by vec_id order by n desc, r, g, b) as rn from n) where rn = 1""")
def color_mode(spark, d):
    q = read(spark, d, "embeddings").select("vec_id", F.expr("explode(transform(sequence(0, 20), i -> struct(cast(floor(embedding[3 * i] * 4) as int) as r, cast(floor(embedding[3 * i + 1] * 4) as int) as g, cast(floor(embedding[3 * i + 2] * 4) as int) as b)))").alias("c"))
    n = q.groupBy("vec_id", "c").agg(F.count("*").alias("n"))
    best = n.groupBy("vec_id").agg(F.min(F.struct((-F.col("n")).alias("m"), "c")).alias("b"))
    return best.select("vec_id", "b.c.r", "b.c.g", "b.c.b", (-F.col("b.m")).alias("n"))


@query("""with recursive g as (select vec_id, i // 8 as y, i % 8 as x, embedding[i + 1] > 0 as on_ from (select *, unnest(range(0, 64)) as i from embeddings)),
 f as (select vec_id, y, x from g where on_ and y = 4 and x = 4 union select g.vec_id, g.y, g.x from f join g on g.vec_id = f.vec_id and abs(g.y - f.y) <= 1 and abs(g.x - f.x) <= 1 where g.on_)
 select vec_id, cast(min(y) as int) as y0, cast(min(x) as int) as x0, cast(max(y) as int) as y1, cast(max(x) as int) as x1, count(*) as n from f group by vec_id""")
def connected_component_bbox(spark, d):
    @F.pandas_udf("y0 int, x0 int, y1 int, x1 int, n long")
    def box(v: pd.Series) -> pd.DataFrame:
        on = np.stack(v.to_numpy()).reshape(-1, 8, 8) > 0 if len(v) else np.zeros((0, 8, 8), bool)
        four = np.full(len(on), 4)
        found, n = component_boxes(on, four, four)
        return pd.DataFrame(np.column_stack([found, n]), columns=["y0", "x0", "y1", "x1", "n"])

    return read(spark, d, "embeddings").select("vec_id", box("embedding").alias("b")).where("b.n > 0").select("vec_id", "b.*")


@query("select user_id, count(*) filter (where event_type = 'click' and value >= 20) as person_count, coalesce(round_even(max(value) filter (where event_type = 'click' and value >= 20), 4), 0) as max_person_conf, cast(count(*) filter (where event_type = 'click' and value >= 20) = 0 as int) as kept from events group by user_id")
def max_conf_per_key(spark, d):
    return route.people_counts(read(spark, d, "events"), "user_id", F.when(F.col("event_type") == "click", 0).otherwise(1), F.col("value"), 20.0)


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as k, cast(json_extract(props, '$.k') as bigint) <> 0 as truthy from events")
def json_props(spark, d):
    e = read(spark, d, "events").select("event_id", F.concat(F.lit("```json\n"), "props", F.lit("\n```")).alias("reply")).withColumn("v", text.json_variant(F.col("reply")))
    return e.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"), text.truthy(F.col("v"), "$.k").alias("truthy"))


@query("""with b as (select doc_id, (row_number() over (order by doc_id) - 1) // 30 as batch, cast((row_number() over (order by doc_id) - 1) % 30 as int) as i from documents),
 r as (select batch, case when batch % 4 = 1 and i = 3 then 4 when batch % 4 = 2 and i = 0 then 99 else i end as i, doc_id % 2 as v from b where not (batch % 4 = 3 and i = 5)),
 ok as (select batch from (select batch, count(*) as want from b group by batch) w join (select batch, count(*) as got, count(distinct i) filter (where i < 30) as good from r group by batch) g using (batch) where got = want and good = want)
 select b.batch, count(*) as n, cast(sum(v) as bigint) as flagged from b join ok using (batch) join r on b.batch = r.batch and b.i = r.i group by b.batch""")
def reply_alignment(spark, d):
    b = shard.batches(read(spark, d, "documents").select("doc_id"), "doc_id", 30)
    i = F.when((F.col("batch") % 4 == 1) & (F.col("i") == 3), 4).when((F.col("batch") % 4 == 2) & (F.col("i") == 0), 99).otherwise(F.col("i"))
    r = b.where("not (batch % 4 = 3 and i = 5)").select("batch", i.alias("i"), (F.col("doc_id") % 2).alias("v"))
    return joins.aligned(b, r).groupBy("batch").agg(F.count("*").alias("n"), F.sum("v").alias("flagged"))


@query("""select (row_number() over (order by doc_id) - 1) // 30 as batch, doc_id from documents""")
def batch_numbers(spark, d):
    return shard.batches(read(spark, d, "documents").select("doc_id"), "doc_id", 30).select("batch", "doc_id")


@query("select doc_id, cast((row_number() over (order by doc_id) - 1) // cast(ceil((select count(*) from documents) / 7.0) as bigint) as int) as shard, printf('train-%05d-of-%05d', (row_number() over (order by doc_id) - 1) // cast(ceil((select count(*) from documents) / 7.0) as bigint), 7) as shard_name from documents")
def shard_ceil(spark, d):
    return shard.ceil_shards(read(spark, d, "documents").select("doc_id"), "doc_id", 7).withColumn("shard_name", F.format_string("train-%05d-of-%05d", F.col("shard"), F.lit(7)))


@query("select doc_id, cast((row_number() over (order by source || '/' || printf('%08d', doc_id)) - 1) % 8 as int) as shard from documents")
def shard_modulo(spark, d):
    named = read(spark, d, "documents").select("doc_id", F.format_string("%s/%08d", F.col("source"), F.col("doc_id")).alias("name"))
    return shard.round_robin(named, "name", 8).select("doc_id", "shard")


#: CRC-32 of a text's UTF-8 bytes in DuckDB: the table by its rule, then one lookup for each byte.
CRC_TABLE = "list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i))"
CRC_OF = "xor(list_reduce(list_transform(regexp_extract_all(hex(encode({})), '..'), lambda x: cast('0x' || x as bigint)), lambda c, x: xor(c >> 8, crc_table[1 + (xor(c, x) & 255)]), 4294967295), 4294967295)"


@query(f"with t as (select {CRC_TABLE} as crc_table) select doc_id, cast({CRC_OF.format('cast(doc_id as varchar)')} % 8 as int) as shard from documents, t")
def shard_crc32(spark, d):
    return read(spark, d, "documents").select("doc_id", shard.hash_shard(F.col("doc_id"), 8).alias("shard"))


@query("select doc_id, source from documents order by md5('7|' || cast(doc_id as varchar)), doc_id limit 100")
def seeded_sample(spark, d):
    return shard.seeded_sample(read(spark, d, "documents").select("doc_id", "source"), "doc_id", 100, 7)


@query("""with a as (select event_id % 2 as s, event_id // 3 as k, event_id, value from events)
 select k, event_id, value from (select *, row_number() over (partition by k order by s, event_id) as rn from a) where rn = 1""")
def upsert_keep_first(spark, d):
    e = read(spark, d, "events").select(F.floor(F.col("event_id") / 3).alias("k"), "event_id", "value")
    old, new = e.where("event_id % 2 = 0").withColumn("s", F.lit(0)), e.where("event_id % 2 <> 0").withColumn("s", F.lit(1))
    return dedup.keep_first(old.unionByName(new), ["k"], ["s", "event_id"]).drop("s")


# Ledgers over all events; their ids are users by week.
_USER_WEEK = "user_id || '_' || cast(floor(epoch_us(ts) / 1e6 / 604800) as bigint)"


def _ids(spark, d, kind):
    week = F.concat(F.col("user_id").cast("string"), F.lit("_"), F.floor(seconds() / (7 * DAY)).cast("string"))
    return read(spark, d, "events").where(F.col("event_type") == kind).select(week.alias("id"))


@query(f"select {_USER_WEEK} as id from events where event_type = 'click' union select {_USER_WEEK} from events where event_type = 'purchase'")
def ledger_union(spark, d):
    return ledger.union_distinct(_ids(spark, d, "click"), _ids(spark, d, "purchase"))


@query(f"select {_USER_WEEK} as id from events where event_type = 'click' except select {_USER_WEEK} from events where event_type = 'purchase'")
def ledger_requeue(spark, d):
    return ledger.requeue(_ids(spark, d, "click"), _ids(spark, d, "purchase"))


@query(f"with e as (select {_USER_WEEK} as id, event_type from events) select distinct id from e where event_type = 'view' and not exists (select 1 from e f where f.id = e.id and f.event_type in ('click', 'purchase'))")
def ledger_pending(spark, d):
    return joins.pending(_ids(spark, d, "view").distinct(), _ids(spark, d, "click"), _ids(spark, d, "purchase"))


@query(f"select {_USER_WEEK} as id, count(*) as tries, count(*) >= 3 as given_up from events where event_type = 'purchase' group by 1")
def attempts_give_up(spark, d):
    return ledger.give_up(_ids(spark, d, "purchase"))


# The same with users by day.
_USER_DAY = "user_id || '_' || cast(floor(epoch_us(ts) / 1e6 / 86400) as bigint)"


def _user_day():
    return F.concat(F.col("user_id").cast("string"), F.lit("_"), F.floor(seconds() / DAY).cast("string"))


def _all_ids(spark, d, kind):
    return read(spark, d, "events").where(F.col("event_type") == kind).select(_user_day().alias("id"))


@query(f"""with a as (select {_USER_DAY} as k, event_id, value, event_id % 2 as s from events)
 select k, event_id, value from (select *, row_number() over (partition by k order by s, event_id) as rn from a) where rn = 1""")
def upsert_keep_first_all(spark, d):
    e = read(spark, d, "events").select(_user_day().alias("k"), "event_id", "value")
    old, new = e.where("event_id % 2 = 0").withColumn("s", F.lit(0)), e.where("event_id % 2 <> 0").withColumn("s", F.lit(1))
    return dedup.keep_first(old.unionByName(new), ["k"], ["s", "event_id"]).drop("s")


@query(f"select {_USER_DAY} as id from events where event_type = 'click' union select {_USER_DAY} from events where event_type = 'purchase'")
def ledger_union_all(spark, d):
    return ledger.union_distinct(_all_ids(spark, d, "click"), _all_ids(spark, d, "purchase"))


@query(f"select {_USER_DAY} as id from events where event_type = 'click' except select {_USER_DAY} from events where event_type = 'purchase'")
def ledger_requeue_all(spark, d):
    return ledger.requeue(_all_ids(spark, d, "click"), _all_ids(spark, d, "purchase"))


@query(f"with e as (select {_USER_DAY} as id, event_type from events) select distinct id from e where event_type = 'view' and not exists (select 1 from e f where f.id = e.id and f.event_type in ('click', 'purchase'))")
def ledger_pending_all(spark, d):
    return joins.pending(_all_ids(spark, d, "view").distinct(), _all_ids(spark, d, "click"), _all_ids(spark, d, "purchase"))


@query(f"select {_USER_DAY} as id, count(*) as tries, count(*) >= 3 as given_up from events where event_type = 'purchase' group by 1")
def attempts_give_up_all(spark, d):
    return ledger.give_up(_all_ids(spark, d, "purchase"))


@query("""with l as (select l_orderkey, count(*) as n from lineitem group by 1) select o_orderkey as k, cast(o_orderkey % 8 as bigint) as size, coalesce(n, 0) as remote_size from orders left join l on o_orderkey = l_orderkey where cast(o_orderkey % 8 as bigint) is distinct from coalesce(n, 0)""")
def pending_reconcile(spark, d):
    local = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 8).alias("size"))
    return joins.size_mismatch(local, read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("size")), "k")


@query("select event_id, user_id from events order by event_id limit 37")
def hwm_admission(spark, d):
    return shard.admit(read(spark, d, "events").select("event_id", "user_id"), "event_id", 63, 100, 50)


@query("with l as (select user_id as id, max(epoch_us(ts)) / 1e6 as ts from events group by 1), n as (select max(epoch_us(ts)) / 1e6 as now from events) select id, round(now - ts, 3) as elapsed, now - ts > 21600 as due from l, n")
def attempts_due(spark, d):
    e = read(spark, d, "events")
    last = e.groupBy(F.col("user_id").alias("id")).agg(F.max(seconds()).alias("ts"))
    now = e.agg(F.max(seconds()).alias("now"))  # one row
    return last.join(F.broadcast(now)).select("id", F.round(F.col("now") - F.col("ts"), 3).alias("elapsed"), retry.due(F.col("ts"), F.col("now")).alias("due"))


@query("""with l as (select conv_id, text from (select *, row_number() over (partition by conv_id order by turn desc, role desc, text desc) as rn from conversations) where rn = 1)
 select cast(conv_id as varchar) as k, md5(text) as v from l""")
def jsonl_last_wins(spark, d):
    """Conversations as JSON lines in several files, in order of turns, and the last line of each."""
    scratch = Scratch(spark)
    rows = read(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("k"), F.md5(F.col("text").cast("binary")).alias("v"), "turn", "role", "text")
    rows.repartitionByRange(4, "turn", "role", "text").sortWithinPartitions("turn", "role", "text").select("k", "v").write.json(f"{scratch.root}/lines")
    return readers.jsonl_map(spark, f"{scratch.root}/lines", "k", "v", "k string, v string")


def _flaky():
    """A stand-in service: every seventh id is refused, others fail with 429 or 503 as often as their id modulo 6 says."""
    tries: dict[str, int] = {}

    def call(text: str) -> tuple[int, str | None, dict[str, int]]:
        n, i = tries.pop(text, 0), int(text)
        if i % 7 == 0:
            return 400, None, {"calls": 1}
        if n < i % 6:
            tries[text] = n + 1
            return (429, 503)[n % 2], None, {"calls": 1}
        return 200, f"ok {text}", {"calls": 1, "tokens": len(text)}

    return call


@query("""with e as (select page_id as i, page_id % 7 = 0 as refused, page_id % 6 as fails from pages)
 select i as page_id, case when not refused and fails < 4 then 'ok ' || cast(i as varchar) end as raw, case when refused then 'HTTP 400' when fails >= 4 then 'HTTP 503' end as error,
  cast(case when refused then 1 when fails < 4 then fails + 1 else 4 end as int) as tries, cast(case when refused then 1 when fails < 4 then fails + 1 else 4 end as bigint) as calls from e""")
def call_retry(spark, d):
    asked = read(spark, d, "pages").select("page_id", models.call_column(_flaky, 4, lambda s: None)(F.col("page_id").cast("string")).alias("r"))
    return asked.select("page_id", "r.raw", "r.error", "r.tries", F.col("r.usage")["calls"].alias("calls"))


def _parity():
    """Flags by a text's length; every batch whose first text has a length divisible by 5 loses an answer."""

    def run(requests):
        out = []
        for request in requests:
            items = json.loads(request)
            got = [{"i": x["i"], "v": str(len(x["text"]) % 2)} for x in items]
            out.append(json.dumps(got[1:] if len(items[0]["text"]) % 5 == 0 else got))
        return out

    return run


models.register("parity", _parity)
_TITLES = "t as (select distinct source || ' ' || lang || ' ' || cast(doc_id % 1000 as varchar) as title from documents), b as (select title, (row_number() over (order by title) - 1) // 30 as batch, (row_number() over (order by title) - 1) % 30 as i from t), f as (select batch, length(title) % 5 = 0 as lost from b where i = 0)"


def _titles(spark, d):
    return read(spark, d, "documents").select(F.concat_ws(" ", "source", "lang", (F.col("doc_id") % 1000).cast("string")).alias("title"))


@query(f"with {_TITLES} select title, cast(length(title) % 2 as varchar) as v from b join f using (batch) where not lost")
def cascade_aligned(spark, d):
    return models.ask_batches(_titles(spark, d), "title", "parity", 30)


models.register("shorter", models.indexed(lambda: lambda texts: ["" if len(t) % 3 == 0 else t if len(t) % 3 == 1 else "plain " + t[-3:] for t in texts]))


@query("""with c as (select doc_id, source || ' logo ' || cast(doc_id as varchar) as caption, source < 'src5' as strong from documents),
 n as (select doc_id, case when strong then caption else replace(caption, 'logo', 'view') end as caption from c)
 select doc_id, case when contains(caption, 'logo') and length(caption) % 3 = 2 then 'plain ' || trim(right(caption, 3)) else caption end as caption from n""")
def composite_fix(spark, d):
    from framequarry.plans import publish

    c = read(spark, d, "documents").select("doc_id", F.concat("source", F.when(F.col("source") < "src5", " logo ").otherwise(" view "), F.col("doc_id").cast("string")).alias("caption"))
    return publish.fix_composites_in_batches(c, "shorter", r"\blogo\b")[0]


@query("""with n as (select doc_id, row_number() over (order by doc_id) - 1 as pos, count(*) over () as n from documents)
 select printf('train-%05d-of-%05d.parquet', pos // cast(ceil(n / 7.0) as bigint), 7) as file, count(*) as n, min(doc_id) as first, max(doc_id) as last from n group by 1""")
def shard_files(spark, d):
    scratch = Scratch(spark)
    writers.shard_files(read(spark, d, "documents").select("doc_id", "source"), "doc_id", 7, f"{scratch.root}/shards")
    rows = spark.read.parquet(f"{scratch.root}/shards").select(F.col("_metadata.file_name").alias("file"), "doc_id")
    return rows.groupBy("file").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


@query("""with w as (select cast(user_id as varchar) as id, min(event_id) as ord from events group by 1), l as (select cast(user_id as varchar) as id, max(epoch_us(ts)) / 1e6 as ts from events where event_type = 'click' group by 1),
 done as (select distinct cast(user_id as varchar) as id from events where event_type = 'purchase' and value > 95), n as (select max(epoch_us(ts)) / 1e6 as now from events)
 select w.id, w.ord from w left join l on w.id = l.id, n where w.id not in (select id from done) and (l.ts is null or now - l.ts > 86400) order by w.ord limit 40""")
def resolver_stream(spark, d):
    """One batch of the resolver: users as ids, clicks as tries, some purchases as done, room for 40 of 100 below the mark."""
    e = read(spark, d, "events").withColumn("id", F.col("user_id").cast("string"))
    waiting = e.groupBy("id").agg(F.min("event_id").alias("ord"))
    tries = e.where("event_type = 'click'").select("id", seconds().alias("ts"))
    now = e.agg(F.max(seconds()).alias("now")).first()["now"]
    return streams.resolve_now(waiting, tries, e.where("event_type = 'purchase' and value > 95").select("id"), now, 60, 100, 50, DAY)


@query("select event_type, event_id % 9 as attempt, least(60.0, pow(2.0, event_id % 9)) as wait, least(1800.0, 300 * pow(2.0, event_id % 9)) as cooldown, count(*) as n from events group by all")
def retry_backoff(spark, d):
    k = F.col("event_id") % 9
    return read(spark, d, "events").groupBy("event_type", k.alias("attempt"), retry.backoff(k).alias("wait"), retry.cooldown(k).alias("cooldown")).agg(F.count("*").alias("n"))


@query("select source, count(*) as files, cast(sum(n_chars) as bigint) as bytes from documents d where exists (select 1 from labels l where l.doc_id = d.doc_id) group by source")
def prune_plan(spark, d):
    plan = route.prune_plan(read(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", F.col("n_chars").alias("size")), read(spark, d, "labels").select(F.col("doc_id").alias("id")))
    return plan.groupBy("source").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


@query("select count(*) filter (where quality = 1) as done, count(*) filter (where quality = 0) as failed, cast(0 as bigint) as empty, count(*) >= 300 as complete from labels")
def completion_barrier(spark, d):
    return route.barrier(read(spark, d, "labels").select(F.when(F.col("quality") == 1, "done").otherwise("failed").alias("status")), 300)


@query("""with w as (select user_id, date_trunc('day', ts) as window_start, event_id, value, row_number() over (partition by user_id, date_trunc('day', ts) order by value desc, ts, event_id) as rn from events)
 select cast(user_id as varchar) as video_id, cast(window_start as varchar) as window_start, event_id as ord, value as score from w where rn = 1 and window_start + interval 1 day <= (select max(ts) - interval 10 minute from events)""")
def stream_frames_available_now(spark, d):
    """The stream's closed windows, through a file source, a watermark, a checkpoint and a Parquet sink."""
    import uuid

    from framequarry.streaming.queries import drain, sharpest_stream

    at = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    src = spark.readStream.schema(spark.read.parquet(f"{d}/events.parquet").schema).option("pathGlobFilter", "events.parquet").parquet(d)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        drain(sharpest_stream(src, "user_id", "ts", "event_id", "value", "1 day"), f"{at}/out", f"{at}/state")
        out = spark.read.parquet(f"{at}/out")
        text_start = F.date_format(F.col("window_start"), "yyyy-MM-dd HH:mm:ss")
        done = out.select(F.col("video_id").cast("string").alias("video_id"), text_start.alias("window_start"), "ord", "score")
        done.write.parquet(f"{at}/named")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    return spark.read.parquet(f"{at}/named")


@query("select doc_id, least(400, length(text)) as cut_len, md5(left(trim(text, ' \n\t'), 50)) as head from documents")
def strip_and_cut(spark, d):
    return read(spark, d, "documents").select("doc_id", F.length(F.left("text", F.lit(400))).cast("long").alias("cut_len"), F.md5(text.cut(F.col("text"), 50).cast("binary")).alias("head"))


@query("select lang, max(n_chars) as most, arg_max(doc_id, n_chars * 100000000 - doc_id) as doc_id from documents group by lang")
def longest_per_lang(spark, d):
    first = dedup.last_wins(read(spark, d, "documents").select("lang", "n_chars", (-F.col("doc_id")).alias("neg")), ["lang"], ["n_chars", "neg"])
    return first.select("lang", F.col("n_chars").alias("most"), (-F.col("neg")).alias("doc_id"))


# Registers its own queries by the decorator above.
from framequarry import stateful_queries  # noqa: E402, F401
