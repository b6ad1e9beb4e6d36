"""Structured Streaming forms of the polling loops."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framequarry.scratch import delete
from framequarry.sinks.writers import upsert


def sharpest_stream(events: DataFrame, video: str, ts: str, order: str, score: str, window: str, late: str = "10 minutes") -> DataFrame:
    """The sharpest event of each closed window; windows stay open until the watermark has passed their end.

    Ranks aren't available on streams, so the maximum of one struct decides; frame numbers come afterwards from the
    whole table. ``ts`` may be TIMESTAMP_NTZ, which a watermark doesn't take.
    """
    df = events.withColumn("fq_ts", F.col(ts).cast("timestamp")).withWatermark("fq_ts", late)
    us = F.unix_micros("fq_ts")
    best = F.max(F.struct(F.col(score).alias("s"), (-us).alias("u"), (-F.col(order)).alias("o"))).alias("b")
    out = df.groupBy(F.col(video).alias("video_id"), F.window("fq_ts", window).alias("w")).agg(best)
    return out.select("video_id", F.col("w.start").alias("window_start"), (-F.col("b.o")).alias("ord"), F.col("b.s").alias("score"))


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Everything that is there now, written as Parquet; a checkpoint makes it resume where it stopped."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def upsert_stream(stream: DataFrame, key: str, folder: str, checkpoint: str) -> None:
    """Batches merged keep-first into versions ``v<batch>`` of a table; a batch that is run again writes its version again
    from the one before, so the last two versions stay and older ones are deleted."""

    def merge(batch: DataFrame, number: int) -> None:
        before = batch.sparkSession.read.parquet(f"{folder}/v{number - 1}") if number else None
        upsert(before, batch, key, f"{folder}/v{number}")
        if number > 1:
            delete(batch.sparkSession, f"{folder}/v{number - 2}")

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def consume(queue: DataFrame, done: DataFrame) -> DataFrame:
    """Queue entries that no ledger has; the ledgers are read as they are when a batch starts."""
    return queue.join(done.select("id").distinct(), "id", "left_anti")


def count_attempts(stream: DataFrame, most: int = 3) -> DataFrame:
    """id, tries and given_up after each batch, by state that is kept for every id until it is given up and then removed:
    an id that comes again after that starts anew."""

    def step(key, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        tries = (state.get[0] if state.exists else 0) + sum(len(p) for p in parts)
        if tries >= most:
            state.remove()
        else:
            state.update((tries,))
        yield pd.DataFrame({"id": [key[0]], "tries": [tries], "given_up": [tries >= most]})

    return stream.groupBy("id").applyInPandasWithState(step, "id string, tries long, given_up boolean", "tries long", "update", "NoTimeout")


def resolve_now(waiting: DataFrame, attempts: DataFrame, done: DataFrame, now: float, depth: int, high_water: int = 50, batch: int = 20, wait: float = 6 * 3600.0) -> DataFrame:
    """id and ord of what is dispatched at ``now``: ids not done, never tried or last tried longer ago than ``wait``, the first ones by
    ord that fit below the high-water mark, at most ``batch``."""
    from framequarry.functions.retry import due
    from framequarry.operators import joins, shard

    last = attempts.groupBy("id").agg(F.max("ts").alias("ts"))
    ready = joins.pending(waiting, done).join(last, "id", "left").where(due(F.col("ts"), F.lit(float(now)), wait)).select("id", "ord")
    return shard.admit(ready, "ord", depth, high_water, batch)


def resolver_stream(queue: DataFrame, done: DataFrame, folder: str, checkpoint: str, clock, depth, **limits) -> None:
    """The resolver over arriving ids (id, ord): each batch adds its ids to the state ``s<batch>`` (id, ord, ts of the last try), dispatches what
    is due (``d<batch>``) and marks it as tried. ``clock`` and ``depth`` are asked once a batch, for the time and the queue's
    depth. A batch that is run again starts from the state before it; the last two states stay."""

    def step(batch: DataFrame, number: int) -> None:
        spark, now = batch.sparkSession, float(clock())
        state = spark.read.parquet(f"{folder}/s{number - 1}") if number else batch.select("id", "ord", F.lit(None).cast("double").alias("ts")).limit(0)
        both = state.unionByName(batch.select("id", "ord", F.lit(None).cast("double").alias("ts")))
        merged = both.groupBy("id").agg(F.min("ord").alias("ord"), F.max("ts").alias("ts"))
        tried = merged.where("ts is not null").select("id", "ts")
        resolve_now(merged.select("id", "ord"), tried, done, now, depth(), **limits).write.mode("overwrite").parquet(f"{folder}/d{number}")
        sent = spark.read.parquet(f"{folder}/d{number}").select("id", F.lit(now).alias("sent"))
        new = merged.join(sent, "id", "left").select("id", "ord", F.coalesce("sent", "ts").alias("ts"))
        new.write.mode("overwrite").parquet(f"{folder}/s{number}")
        if number > 1:
            delete(spark, f"{folder}/s{number - 2}")

    queue.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
