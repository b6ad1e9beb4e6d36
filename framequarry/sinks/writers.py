"""Sinks (K1-K6, K10-K12, K14, K16, K18): tables, line files, image files and contiguous shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framequarry.operators.dedup import keep_first, last_wins
from framequarry.operators.shard import ceil_shards
from framequarry.sources import files


def upsert(existing: DataFrame | None, new: DataFrame, key: str, path: str, order: str | None = None) -> DataFrame:
    """Existing rows first, then new ones with unseen keys, written as a new version beside the old one.

    ``path`` names the version to write; a reader changes over to it only when its _SUCCESS is there, so that a lost
    executor or driver never leaves half a table in place of a whole one.
    """
    old = (existing if existing is not None else new.limit(0)).withColumn("fq_src", F.lit(0))
    both = old.unionByName(new.withColumn("fq_src", F.lit(1)), allowMissingColumns=True)
    out = keep_first(both, [key], ["fq_src", order or key]).drop("fq_src")
    out.write.mode("overwrite").parquet(path)
    return new.sparkSession.read.schema(out.schema).parquet(path)


def state_upsert(existing: DataFrame, marks: DataFrame, key: str = "id", ts: str = "ts") -> DataFrame:
    """The last mark of each key."""
    return last_wins(existing.unionByName(marks), [key], [ts])


def write_both(df: DataFrame, folder: str, name: str = "metadata") -> None:
    """CSV and Parquet of the same rows."""
    df.write.mode("overwrite").csv(f"{folder}/{name}.csv", header=True, quote='"', escape='"')
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def rewrite_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """The distinct values in order, one a line."""
    df.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct().orderBy("value").write.mode("overwrite").text(path)


def route(df: DataFrame, path: str, status: str = "filter_status") -> None:
    """Rows in one folder for each status, which stands for moving files around."""
    df.write.mode("overwrite").partitionBy(status).parquet(path)


def write_images(df: DataFrame, folder: str, name: str = "name", content: str = "bytes") -> None:
    """Each row's bytes as a file; files appear once all are whole (``sources/files.py``)."""
    files.write_files(df, folder, name, content)


def write_shards(df: DataFrame, order: str, shards: int, folder: str) -> DataFrame:
    """Parquet files ``train-xxxxx-of-nnnnn`` as partitions of contiguous rows; empty shards have none, names keep n."""
    placed = ceil_shards(df, order, shards)
    named = placed.withColumn("shard_name", F.format_string("train-%05d-of-%05d", F.col("shard"), F.lit(shards)))
    named.repartitionByRange(shards, "shard", order).sortWithinPartitions("shard", order).drop("shard").write.mode("overwrite").partitionBy("shard_name").parquet(folder)
    return named.groupBy("shard_name").agg(F.count("*").alias("n"))


def shard_files(df: DataFrame, order: str, shards: int, folder: str) -> list[str]:
    """Shards as files ``train-xxxxx-of-nnnnn.parquet`` in ``folder``; names of those written. A shard is one file, hence one
    task's work; rows are written below ``_parts`` and files put in place by rename once all are whole."""
    spark = df.sparkSession
    placed = ceil_shards(df, order, shards)
    placed.repartition(shards, "shard").sortWithinPartitions("shard", order).write.mode("overwrite").partitionBy("shard").parquet(f"{folder}/_parts")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs, names = path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), []
    for k in range(shards):
        for found in fs.globStatus(path(f"{folder}/_parts/shard={k}/part-*.parquet")) or []:
            names.append(f"train-{k:05d}-of-{shards:05d}.parquet")
            fs.delete(path(f"{folder}/{names[-1]}"), False)
            fs.rename(found.getPath(), path(f"{folder}/{names[-1]}"))
    fs.delete(path(f"{folder}/_parts"), True)
    return names


def write_report(df: DataFrame, folder: str, shard: str) -> None:
    """A shard's report as CSV, then its marker ``<shard>.done``, which is there only if the report is whole."""
    df.write.mode("overwrite").csv(f"{folder}/{shard}.csv", header=True, quote='"', escape='"')
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{folder}/{shard}.done")
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).create(path, True).close()
