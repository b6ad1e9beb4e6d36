"""Set operations on ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_distinct(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def union_reports(frames: list[DataFrame | None]) -> DataFrame:
    """All rows of the shard reports that exist; at least one has to."""
    here = [f for f in frames if f is not None]
    if not here:
        raise ValueError("no shard report was found")
    out = here[0]
    for f in here[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def missing(remote: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct remote ids that aren't known, in order."""
    return remote.select("id").subtract(known.select("id")).orderBy("id")


def requeue(sent: DataFrame, failed: DataFrame) -> DataFrame:
    """The sent set without what failed, so that it is sent again."""
    return sent.select("id").subtract(failed.select("id"))


def give_up(attempts: DataFrame, most: int = 3) -> DataFrame:
    """Attempts of each id and whether they are used up."""
    return attempts.groupBy("id").agg(F.count("*").alias("tries")).withColumn("given_up", F.col("tries") >= most)
