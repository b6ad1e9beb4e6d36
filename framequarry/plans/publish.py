"""From the final table to descriptions, cleaned texts and shards (third entry point)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framequarry import models
from framequarry.functions.text import DESCRIPTION_LIMIT, STRONG, TEXTY, cut, json_variant
from framequarry.operators import joins
from framequarry.scratch import Scratch


def describe(final: DataFrame, done: DataFrame | None = None, model: str = "describe") -> DataFrame:
    rows = final if done is None else joins.todo(final, done, "image_id")
    asked = rows.select("image_id", "image_filename", models.caller(model)(F.col("image_id")).alias("r"))
    v = asked.withColumn("v", json_variant(F.col("r.raw")))
    text = F.coalesce(*(cut(F.try_variant_get("v", f"$.{k}", "string"), DESCRIPTION_LIMIT) for k in ("descriptive_text", "prompt_text")))
    return v.select("image_id", "image_filename", text.alias("descriptive_text"), F.lit(model).alias("model"), F.col("r.error").alias("error"), F.col("r.raw").alias("raw_response"))


def clean(df: DataFrame, text: str, scratch: str, pattern: str = TEXTY) -> DataFrame:
    """Texts that speak of overlays, rewritten on every row that has them."""
    flags, cleans = models.cascade(df, text, pattern, "flag", "rewrite", scratch)
    return joins.apply_cleans(df, flags, cleans, text)


def fix_composites(df: DataFrame, rewrite, pattern: str = STRONG, text: str = "caption") -> tuple[DataFrame, DataFrame]:
    """Strong mentions replaced by ``rewrite`` (a column function), all at once; and how many mentions there were and are."""
    hit = F.col(text).rlike(pattern)
    out = df.withColumn(text, F.when(hit, F.coalesce(rewrite(F.col(text)), F.col(text))).otherwise(F.col(text)))
    counts = df.agg(F.count_if(hit).alias("before")).join(out.agg(F.count_if(hit).alias("after")))  # one row each
    return out, counts


def fix_composites_in_batches(df: DataFrame, model: str, pattern: str = STRONG, text: str = "caption", size: int = 40, show: int = 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Strong mentions rewritten by a batch model, each reply accepted on its own: it has to answer a requested index, be non-empty
    and differ. All rewrites are one map from old to new, applied at once. Also the counts before and after, and the first
    ``show`` texts that still match."""
    hit = F.col(text).rlike(pattern)
    new = models.ask_batches(df.where(hit), text, model, size, whole=False).select(F.col(text).alias("fq_old"), cut(F.col("v"), DESCRIPTION_LIMIT).alias("fq_new"))
    new = Scratch(df.sparkSession).write(new.where("fq_new is not null and fq_new <> fq_old"))
    out = df.join(new, F.col(text) == F.col("fq_old"), "left").withColumn(text, F.coalesce("fq_new", F.col(text))).drop("fq_old", "fq_new")
    counts = df.agg(F.count_if(hit).alias("before")).join(out.agg(F.count_if(hit).alias("after")))  # one row each
    return out, counts, out.where(hit).select(text).distinct().orderBy(text).limit(show)


def shard_rows(final: DataFrame, pictures: DataFrame) -> DataFrame:
    """Rows of the published shards: image bytes and path, then the scalars; descriptive_text only if there is one."""
    # The columns of the published table, in their order.
    names = ["image_id", "image_filename", "video_id", "video_title", "video_url", "timestamp_seconds", "caption", "descriptive_text", "had_overlay", "overlay_inpainted", "n_boxes"]
    p = pictures.select(F.col("name").alias("fq_p"), "bytes")
    both = final.join(p, F.col("image_filename") == F.col("fq_p"))
    return both.select(F.struct("bytes", F.col("image_filename").alias("path")).alias("image"), *(c for c in names if c in final.columns))
