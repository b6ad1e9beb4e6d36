"""Queue entries claimed by workers with a lease (R3): a claim is a commit, so two workers never hold the same id.

Table ``claims`` of a commit log has a row for each claim of an id, ``results`` one row for each finished id. A worker takes the first open ids in
order, as many as its bound of unfinished ones allows. What it doesn't bring back before its lease ends is open again, and
what it brings back later is refused, since another one may hold it. Taking is a top-k of two anti-joins; ``cut_down``
drops claims that are over.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framequarry.sinks.commits import Change, CommitLog, Snapshot

CLAIM = "id string, worker string, claim string, until double"


class Claims:
    def __init__(self, log: CommitLog, queue: DataFrame, lease_s: float = 3600.0, in_flight: int = 5):
        """``queue`` has id and ord. Ids are compared as text; repeated ids are one entry with the smallest ord, null ids are left out."""
        self.log, self.lease_s, self.in_flight = log, lease_s, in_flight
        self.queue = queue.where("id is not null").groupBy(F.col("id").cast("string").alias("id")).agg(F.min("ord").alias("ord"))

    def _held(self, s: Snapshot, now: float) -> DataFrame:
        """Claims that hold at ``now``: not run out and not finished."""
        claims = s.table("claims") if "claims" in s else self.log.spark.createDataFrame([], CLAIM)
        claims = claims.where(F.col("until") > now)
        return claims.join(s.table("results").select("id"), "id", "left_anti") if "results" in s else claims

    def take(self, worker: str, most: int, now: float) -> DataFrame:
        """id, worker, claim and until of what the worker gets, at most ``most`` ids and no more than its bound; empty if nothing is open."""
        claim = uuid.uuid4().hex

        def build(s: Snapshot) -> dict[str, Change]:
            held = self._held(s, now)
            room = max(0, min(most, self.in_flight - held.where(F.col("worker") == worker).select("id").distinct().count()))
            open_ = self.queue.join(held.select("id"), "id", "left_anti")
            if "results" in s:
                open_ = open_.join(s.table("results").select("id"), "id", "left_anti")
            got = open_.orderBy("ord", "id").limit(room).select("id", F.lit(worker).alias("worker"), F.lit(claim).alias("claim"), F.lit(now + self.lease_s).alias("until"))
            return {"claims": Change(got)} if room else {}

        self.log.commit(build, reads=("claims", "results"))
        s = self.log.snapshot()
        return s.table("claims").where(F.col("claim") == claim) if "claims" in s else self.log.spark.createDataFrame([], CLAIM)

    def renew(self, claim: str, now: float) -> None:
        """The lease of what is still held runs from ``now``."""

        def build(s: Snapshot) -> dict[str, Change]:
            mine = self._held(s, now).where(F.col("claim") == claim).select("id", "worker", "claim").distinct()
            return {"claims": Change(mine.withColumn("until", F.lit(now + self.lease_s)))}

        self.log.commit(build, reads=("claims", "results"))

    def finish(self, claim: str, results: DataFrame, now: float) -> None:
        """Results (id and any columns) of ids that the claim still holds; others are left out, and so is a second one of an id."""

        def build(s: Snapshot) -> dict[str, Change]:
            held = self._held(s, now).where(F.col("claim") == claim).select("id").distinct()
            rows = results.withColumn("id", F.col("id").cast("string")).join(held, "id", "left_semi").select(results.columns)
            return {"results": Change(rows, "upsert", "id")}

        self.log.commit(build, reads=("claims",))

    def cut_down(self, now: float) -> None:
        """Claims that are over go."""
        self.log.commit(lambda s: {"claims": Change(self._held(s, now), "replace")} if "claims" in s else {}, reads=("results",))
