"""From candidate frames to the frame table and the people filter (stages 1-7 of the first entry point)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framequarry import models
from framequarry.functions.text import verdict_keep_drop, verdict_yes_no
from framequarry.operators import frames, joins, route


def extract(candidates: DataFrame, playlist: DataFrame, interval: float = 2.0, done: DataFrame | None = None) -> DataFrame:
    """Frame metadata of videos that aren't done: sharpest candidate of each window, numbered, with titles."""
    rows = candidates if done is None else candidates.join(done.select("video_id").distinct(), "video_id", "left_anti")
    return frames.frame_rows(frames.sharpest(rows, "video_id", F.col("t"), "cand_idx", "score", interval), playlist, 1.0 / interval)


def video_status(candidates: DataFrame, extracted: DataFrame) -> DataFrame:
    """done for videos with frames, empty for those without, so that each video ends (H6)."""
    have = extracted.select(F.col("video_id").alias("fq_v")).distinct()
    out = candidates.select("video_id").distinct().join(have, F.col("video_id").cast("string") == F.col("fq_v"), "left")
    return out.select("video_id", F.when(F.col("fq_v").isNotNull(), "done").otherwise("empty").alias("status"))


def classify(frame_table: DataFrame, done: DataFrame | None = None, model: str = "people_yes_no", batch: int = 24) -> DataFrame:
    """filter_status and raw_response of frames that aren't classified yet."""
    rows = frame_table if done is None else joins.todo(frame_table, done, "image_id")
    asked = rows.withColumn("r", models.caller(model, batch)(F.col("image_id")))
    verdict = verdict_keep_drop if model == "keep_drop" else verdict_yes_no
    raw = F.upper("r.raw") if model == "keep_drop" else F.col("r.raw")
    return asked.withColumns({"filter_status": verdict(F.col("r.raw")), "raw_response": raw}).drop("r")


def detect_people(frame_table: DataFrame, done: DataFrame | None = None, model: str = "person_boxes", least: float = 0.2, batch: int = 32) -> DataFrame:
    """person_count, max_person_conf, kept and error of frames that aren't counted yet, from the detector's boxes (class, confidence).

    A failed call or a reply that isn't a list of boxes is an error, without counts and not kept; an empty list is a frame without people.
    """
    rows = frame_table if done is None else joins.todo(frame_table, done, "image_id")
    asked = rows.select("image_id").distinct().withColumn("r", models.caller(model, batch)(F.col("image_id")))
    boxes = F.from_json("r.raw", "array<struct<cls:int,conf:double>>")
    whole = F.get_json_object("r.raw", "$").startswith("[") & ~F.coalesce(F.exists(boxes, lambda b: b.cls.isNull() | b.conf.isNull()), F.lit(True))
    bad = F.coalesce(F.col("r.error"), F.when(~F.coalesce(whole, F.lit(False)), "unreadable reply"))
    read = asked.select("image_id", bad.alias("error"), boxes.alias("boxes"))
    each = read.where("error is null").select("image_id", F.explode_outer("boxes").alias("b"))
    counts = route.people_counts(each, "image_id", F.col("b.cls"), F.col("b.conf"), least)
    failed = read.where("error is not null").select("image_id", "error")
    return counts.withColumn("error", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True).withColumn("kept", F.coalesce("kept", F.lit(0)))


def consolidate(frame_table: DataFrame, classified: DataFrame, folder: str = "no_people") -> DataFrame:
    """Metadata of kept frames, re-pointed."""
    from framequarry.functions.ids import repoint

    keep = classified.where("filter_status = 'KEEP'").select("image_id").distinct()
    return frame_table.join(keep, "image_id", "left_semi").withColumn("relative_path", repoint(folder, F.col("image_filename")))
