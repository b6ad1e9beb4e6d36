"""Sharpest frame of each window (A1, W1-W3, P6, H8) and the playlist join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framequarry.functions import ids


def sharpest(df: DataFrame, video: str, t: Column, order: str, score: str, interval: float) -> DataFrame:
    """video, bucket, t, order, score, frame_index of the highest score in every ``interval`` of t; of ties the earliest.

    The maximum of one struct is combined before the shuffle, so only one row for each window and task moves. Frames
    are then numbered from 1 in each video.
    """
    rows = df.select(F.col(video).alias("video_id"), t.alias("t"), F.col(order).alias("ord"), F.col(score).alias("score"))
    rows = rows.withColumn("bucket", F.floor(F.col("t") / interval))
    best = rows.groupBy("video_id", "bucket").agg(F.max(F.struct("score", (-F.col("t")).alias("neg_t"), (-F.col("ord")).alias("neg_ord"))).alias("b"))
    out = best.select("video_id", "bucket", (-F.col("b.neg_t")).alias("t"), (-F.col("b.neg_ord")).alias("ord"), F.col("b.score").alias("score"))
    return out.withColumn("frame_index", F.row_number().over(Window.partitionBy("video_id").orderBy("bucket")))


def frame_rows(best: DataFrame, playlist: DataFrame, fps: float, folder: str = "frames") -> DataFrame:
    """Frame metadata with titles and addresses of the playlist where it has them."""
    dim = playlist.select(F.col("id").cast("string").alias("p_id"), "title", "url")
    named = best.withColumn("video_id", F.col("video_id").cast("string")).join(dim, F.col("video_id") == F.col("p_id"), "left")
    name = ids.image_filename(F.col("video_id"), F.col("frame_index"))
    return named.select(
        ids.image_id(F.col("video_id"), F.col("frame_index")).alias("image_id"), name.alias("image_filename"), F.concat(F.lit(folder + "/"), name).alias("relative_path"), "video_id",
        F.col("title").alias("video_title"), F.bround("t", 2).alias("timestamp_seconds"), F.col("frame_index").cast("int").alias("frame_index"), F.lit(fps).alias("fps_sampled"), ids.default_url(F.col("url"), F.col("video_id")).alias("video_url"),
    )
