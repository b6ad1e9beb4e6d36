"""Tri-state routing and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framequarry.functions.text import percent, strip


def route_of(drop: Column, error: Column) -> Column:
    """ERROR if there is an error or no decision, else DROP or KEEP."""
    return F.when(error.isNotNull() | drop.isNull(), "ERROR").when(drop, "DROP").otherwise("KEEP")


def clean_candidates(df: DataFrame, text: str = "caption") -> DataFrame:
    return df.where((route_of(F.col("drop"), F.col("error")) == "KEEP") & (F.coalesce(strip(F.col(text)), F.lit("")) != ""))


def people_counts(df: DataFrame, key: str, cls: Column, conf: Column, least: float = 0.2) -> DataFrame:
    """person_count, max_person_conf (0 if none, 4 places half to even) and kept for every key."""
    person = (cls == 0) & (conf >= least)
    out = df.groupBy(key).agg(F.count_if(person).alias("person_count"), F.bround(F.coalesce(F.max(F.when(person, conf)), F.lit(0.0)), 4).alias("max_person_conf"))
    return out.withColumn("kept", (F.col("person_count") == 0).cast("int"))


def funnel(df: DataFrame, status: str = "filter_status") -> DataFrame:
    """One row: total, keep, drop and others, with percentages."""
    n = lambda c: F.count_if(c)
    s = F.col(status)
    out = df.agg(F.count("*").alias("total"), n(s == "KEEP").alias("keep"), n(s == "DROP").alias("drop"), n(F.coalesce(~s.isin("KEEP", "DROP"), F.lit(True))).alias("unclear"))
    return out.withColumns({"keep_pct": percent(F.col("keep"), F.col("total")), "drop_pct": percent(F.col("drop"), F.col("total"))})


def final_report(classified: DataFrame, metadata: DataFrame) -> DataFrame:
    """The funnel beside the number of metadata rows, and whether that equals KEEP."""
    out = funnel(classified).join(metadata.agg(F.count("*").alias("metadata_rows")))  # one row each
    return out.withColumn("status", F.when(F.col("metadata_rows") == F.col("keep"), "OK").otherwise("MISMATCH"))


def barrier(status: DataFrame, expected: int) -> DataFrame:
    """done, failed, empty and whether all expected videos ended; EMPTY counts as ended (H6)."""
    s = F.lower("status")
    out = status.agg(F.count_if(s == "done").alias("done"), F.count_if(s == "failed").alias("failed"), F.count_if(s == "empty").alias("empty"))
    return out.withColumn("complete", F.col("done") + F.col("failed") + F.col("empty") >= expected)


def stage_status(**stages: DataFrame) -> DataFrame:
    """One row for each stage: its name and the rows of its table."""
    out = None
    for name, df in stages.items():
        one = df.agg(F.lit(name).alias("stage"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def prune_plan(videos: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Files of finished videos; nothing is deleted here."""
    return videos.join(done.select(key).distinct(), key, "left_semi")


def freed(plan: DataFrame) -> DataFrame:
    return plan.agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def audit(classified: DataFrame, key: str, keep: int = 200, drop: int = 100, seed: int = 0) -> DataFrame:
    """Rows for a human to look at: a stable sample of those kept and of those dropped."""
    from framequarry.operators.shard import seeded_sample

    parts = [seeded_sample(classified.where(F.col("filter_status") == s), key, n, seed) for s, n in (("KEEP", keep), ("DROP", drop))]
    return parts[0].unionByName(parts[1])


def throughput(done: DataFrame, started: float, now: float, total: int) -> DataFrame:
    """rows, rows a second and seconds left of a running step."""
    out = done.agg(F.count("*").alias("done")).withColumn("rate", F.round(F.col("done") / max(1e-9, now - started), 3))
    return out.withColumn("eta_seconds", F.round((total - F.col("done")) / F.greatest(F.col("rate"), F.lit(1e-9)), 1))
