"""The resolver in one go (R5, S21): the first due ids are resolved until a batch of addresses is there, and results are fetched back.

Table ``attempts`` of a commit log has a row for each call, with its address or error; ``results`` one row for each dispatched id that came
back. Every round is a commit, so a run that is lost has called no id that it doesn't know of but those of its last round.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framequarry.functions.retry import due
from framequarry.sinks.commits import Change, CommitLog, Snapshot

ATTEMPT = "id string, ts double, run string, url string, error string"


def attempts(s: Snapshot) -> DataFrame:
    return s.table("attempts") if "attempts" in s else s.log.spark.createDataFrame([], ATTEMPT)


def dispatched(s: Snapshot) -> DataFrame:
    """Distinct ids that have an address."""
    return attempts(s).where("url is not null").select("id").distinct()


def queue_depth(log: CommitLog) -> int:
    """Dispatched ids that haven't come back."""
    s = log.snapshot()
    out = dispatched(s)
    return (out.join(s.table("results").select("id"), "id", "left_anti") if "results" in s else out).count()


def resolve_batch(log: CommitLog, ids: DataFrame, done: DataFrame, call: Callable[[Column], Column], now: float, batch: int = 20, wait_s: float = 6 * 3600.0) -> DataFrame:
    """id and url of at most ``batch`` ids that ``call`` (id to a struct of raw and error, as ``models.call_column`` makes it) finds an address for.

    ``ids`` (id, ord) are taken in order, without those done, dispatched and back, or tried within ``wait_s``. An id without an address counts as tried, and
    the next one takes its place, until the batch is full or nothing is due. Null ids are left out, repeated ones are one.
    """
    run = uuid.uuid4().hex
    wanted = ids.where("id is not null").groupBy(F.col("id").cast("string").alias("id")).agg(F.min("ord").alias("ord"))
    wanted = wanted.join(done.select(F.col("id").cast("string").alias("id")).distinct(), "id", "left_anti")
    found = 0
    while found < batch:

        def build(s: Snapshot, room: int = batch - found) -> dict[str, Change]:
            last = attempts(s).groupBy("id").agg(F.max("ts").alias("ts"))
            left = wanted.join(s.table("results").select("id"), "id", "left_anti") if "results" in s else wanted
            first = left.join(last, "id", "left").where(due(F.col("ts"), F.lit(float(now)), wait_s)).orderBy("ord", "id").limit(room)
            asked = first.select("id", call(F.col("id")).alias("r"))
            return {"attempts": Change(asked.select("id", F.lit(float(now)).alias("ts"), F.lit(run).alias("run"), F.col("r.raw").alias("url"), F.col("r.error").alias("error")))}

        before = log.snapshot()
        tried = attempts(before).where(F.col("run") == run).count()
        log.commit(build, reads=("attempts", "results"))
        mine = attempts(log.snapshot()).where(F.col("run") == run)
        now_tried, found = mine.agg(F.count("*"), F.count("url")).first()
        if now_tried == tried:
            break
    return attempts(log.snapshot()).where((F.col("run") == run) & F.col("url").isNotNull()).select("id", "url")


def fetch(log: CommitLog, results: DataFrame) -> int:
    """Takes in results (id and any columns) of dispatched ids, each once; the number of ids still out."""

    def build(s: Snapshot) -> dict[str, Change]:
        rows = results.withColumn("id", F.col("id").cast("string")).join(dispatched(s), "id", "left_semi").select(results.columns)
        return {"results": Change(rows, "upsert", "id")}

    log.commit(build)
    return queue_depth(log)
