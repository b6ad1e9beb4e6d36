"""From frames to detections, refined boxes, masks and the final table (second entry point)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framequarry import models
from framequarry.functions import boxes, ids, images
from framequarry.functions.text import CAPTION_LIMIT, ERROR_LIMIT, cut, drop_reason, json_variant, truthy
from framequarry.operators import joins
from framequarry.operators.route import route_of

PROMPT = "List overlays as boxes, say whether to drop the image and why, and caption it; reply in JSON.\n"


def normalise(df: DataFrame, raw: str = "raw_response", error: str = "error") -> DataFrame:
    """drop, drop_reason, caption and boxes out of raw replies; what can't be parsed leaves all of them null."""
    v = df.withColumn("fq_v", json_variant(F.col(raw)))
    get = lambda k: F.try_variant_get("fq_v", f"$.{k}", "string")
    found = F.coalesce(boxes.dedupe(boxes.clamp(boxes.parse_boxes(F.col("fq_v")))), F.array().cast("array<struct<label:string,box:array<double>>>"))
    ok = F.col("fq_v").isNotNull()
    return v.withColumns({
        "drop": F.when(ok, truthy(F.col("fq_v"), "$.drop")), "drop_reason": drop_reason(get("drop_reason")), "caption": cut(get("caption"), CAPTION_LIMIT),
        "boxes": F.when(ok, found), error: F.left(F.col(error), F.lit(ERROR_LIMIT)),
    }).drop("fq_v")


def detect(frame_table: DataFrame, done: DataFrame | None = None, model: str = "detect") -> DataFrame:
    """Detections of frames that have none yet; earlier errors are tried again (H4)."""
    rows = frame_table if done is None else joins.todo(frame_table, done, "image_id")
    asked = rows.withColumn("r", models.caller(model)(F.concat("image_id", models.prompt(PROMPT, F.col("video_title"), F.col("video_url")))))
    return normalise(asked.withColumns({"raw_response": F.col("r.raw"), "error": F.col("r.error"), "model": F.lit(model)}).drop("r"))


def refine(detections: DataFrame, pictures: DataFrame) -> DataFrame:
    """boxes refined where the picture (name, bytes, h, w) is known; boxes_original holds what was there."""
    p = pictures.select(F.col("name").alias("fq_p"), "bytes", "h", "w")
    both = detections.join(p, F.col("image_filename") == F.col("fq_p"), "left").withColumn("boxes_original", F.col("boxes"))
    return both.withColumn("boxes", F.when(F.col("bytes").isNotNull() & F.col("boxes").isNotNull(), images.refine_boxes("bytes", F.coalesce("h", F.lit(0)), F.coalesce("w", F.lit(0)), "boxes")).otherwise(F.col("boxes"))).drop("fq_p", "bytes", "h", "w")


def masks(detections: DataFrame, sizes: DataFrame, pad: int = 8) -> DataFrame:
    """A mask for every kept image, all zero if no box is valid (H10), with its area and number of boxes."""
    s = sizes.select(F.col("name").alias("fq_s"), "h", "w")
    kept = detections.where((route_of(F.col("drop"), F.col("error")) == "KEEP") & (boxes.count(F.col("boxes")) > 0)).join(s, F.col("image_filename") == F.col("fq_s"))
    px = kept.withColumn("px", boxes.to_pixels(boxes.clamp(F.col("boxes")), F.col("w"), F.col("h"), pad))
    return px.select("image_id", F.concat(ids.stem(F.col("image_filename")), F.lit(".png")).alias("mask_name"), "h", "w", F.size("px").alias("n_boxes"), images.mask("h", "w", "px").alias("mask"), images.mask_area("h", "w", "px").alias("area"))


def inpaint(pictures: DataFrame, mask_table: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Masked pictures without an output yet: name and bytes."""
    m = mask_table.select(ids.stem(F.col("mask_name")).alias("fq_m"), "mask")
    both = pictures.join(m, ids.stem(F.col("name")) == F.col("fq_m"))
    if done is not None:
        both = both.join(done.select(ids.stem(F.col("name")).alias("fq_d")).distinct(), F.col("fq_m") == F.col("fq_d"), "left_anti")
    return both.select("name", images.inpaint_mean("bytes", "mask").alias("bytes"))


def assemble(detections: DataFrame, originals: DataFrame, inpainted: DataFrame, limit: int = 0) -> DataFrame:
    """The final table; the limit counts rows that are kept (L3)."""
    out = joins.assemble(detections, originals, inpainted)
    return out.orderBy("image_id").limit(limit) if limit else out
