"""Semi, anti and update joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framequarry.functions.text import strip
from framequarry.operators.dedup import digest, last_wins


def todo(df: DataFrame, done: DataFrame, key: str, retry_errors: bool = True) -> DataFrame:
    """Rows whose key isn't done, keys compared stripped. Done rows with an error are tried again unless told otherwise."""
    if retry_errors and "error" in done.columns:
        done = done.where("error is null")
    seen = done.select(strip(F.col(key).cast("string")).alias("fq_done")).distinct()
    return df.join(seen, strip(F.col(key).cast("string")) == F.col("fq_done"), "left_anti")


def pending(ids: DataFrame, *ledgers: DataFrame, key: str = "id") -> DataFrame:
    """ids without those of any ledger."""
    for ledger in ledgers:
        ids = ids.join(ledger.select(key).distinct(), key, "left_anti")
    return ids


def existing(df: DataFrame, files: DataFrame, name: str = "image_filename") -> DataFrame:
    return df.join(files.select(F.col("name").alias("fq_name")).distinct(), F.col(name) == F.col("fq_name"), "left_semi")


def apply_cleans(df: DataFrame, flags: DataFrame, cleans: DataFrame, text: str = "caption") -> DataFrame:
    """``text`` replaced on every row with a flagged text that has a non-empty rewrite, dropped rows included.

    ``flags`` and ``cleans`` hold one row for each text, named by ``text`` or by its ``digest``. Both are joined at once, so a rewrite is never
    rewritten (H15), and on digests of 32 bytes, so of flags and rewrites no text moves and of ``df`` each text once.
    """
    of = lambda side: F.col("digest") if "digest" in side.columns else digest(F.col(text))
    f = flags.select(of(flags).alias("fq_f"), "flag").where("flag = 1").join(cleans.select(of(cleans).alias("fq_f"), "clean").where("clean <> ''"), "fq_f")
    joined = df.withColumn("fq_d", digest(F.col(text))).join(f, F.col("fq_d") == F.col("fq_f"), "left")
    return joined.withColumn(text, F.coalesce("clean", text)).select(*df.columns)


def merge_descriptions(meta: DataFrame, descriptions: DataFrame, key: str = "image_id", order: str = "ord") -> DataFrame:
    """descriptive_text right after caption: the last non-empty one of each key, the legacy column where the new one is empty."""
    empty = lambda c: F.nullif(F.col(c), F.lit(""))
    text = F.coalesce(empty("descriptive_text"), empty("prompt_text")) if "prompt_text" in descriptions.columns else empty("descriptive_text")
    rows = descriptions.select(strip(F.col(key).cast("string")).alias("fq_key"), text.alias("descriptive_text"), order).where("descriptive_text is not null")
    last = last_wins(rows, ["fq_key"], [order]).drop(order)
    out = meta.drop("descriptive_text").join(last, strip(F.col(key).cast("string")) == F.col("fq_key"), "left")
    names = [c for c in meta.columns if c != "descriptive_text"]
    at = names.index("caption") + 1 if "caption" in names else len(names)
    return out.select(*names[:at], "descriptive_text", *names[at:])


def assemble(detections: DataFrame, originals: DataFrame, inpainted: DataFrame, folder: str = "images") -> DataFrame:
    """Kept detections with a source: the inpainted file if there is one (whatever the boxes, H9), else the original."""
    from framequarry.functions import ids
    from framequarry.operators.route import route_of

    i = inpainted.select(F.col("name").alias("fq_i")).distinct()
    o = originals.select(F.col("name").alias("fq_o")).distinct()
    name, n_boxes = F.col("image_filename"), F.coalesce(F.size("boxes"), F.lit(0))
    kept = detections.where(route_of(F.col("drop"), F.col("error")) == "KEEP")
    both = kept.join(i, ids.stem(name) == ids.stem(F.col("fq_i")), "left").join(o, name == F.col("fq_o"), "left").where("fq_i is not null or fq_o is not null")
    return both.withColumns({
        "relative_path": ids.repoint(folder, name), "had_overlay": n_boxes > 0, "overlay_inpainted": F.col("fq_i").isNotNull(), "n_boxes": n_boxes,
    }).select("image_id", "image_filename", "relative_path", "video_id", "video_title", "video_url", "timestamp_seconds", "caption", "had_overlay", "overlay_inpainted", "n_boxes")


def size_mismatch(local: DataFrame, remote: DataFrame, key: str = "name") -> DataFrame:
    """Local rows that are missing or of another size on the other side; missing counts as 0."""
    r = remote.select(F.col(key).alias("fq_r"), F.col("size").alias("remote_size"))
    out = local.join(r, F.col(key) == F.col("fq_r"), "left").drop("fq_r")
    return out.withColumn("remote_size", F.coalesce("remote_size", F.lit(0))).where(~F.col("size").eqNullSafe(F.col("remote_size")))


def aligned(requests: DataFrame, replies: DataFrame, batch: str = "batch", i: str = "i") -> DataFrame:
    """Reply values of batches that are complete: every requested index answered once, none beyond."""
    size = requests.groupBy(batch).agg(F.count("*").alias("want"))
    inside = replies.join(size, batch).groupBy(batch).agg(F.first("want").alias("want"), F.count("*").alias("got"), F.count_distinct(F.when((F.col(i) >= 0) & (F.col(i) < F.col("want")), F.col(i))).alias("good"))
    whole = inside.where("got = want and good = want").select(batch)
    return requests.join(whole, batch, "left_semi").join(replies, [batch, i])
