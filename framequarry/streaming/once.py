"""Work done once for each key of a stream, in bounded state.

``first_within`` drops repeats inside a horizon by Spark's own state, which the watermark keeps bounded. ``once_stream`` is exact at any
distance: keys that are done are kept in an index dealt out by hash, so a batch reads the index partitions of its own
keys and nothing of the results of earlier batches. A batch that is run again after a crash takes over what it had
finished, so nothing is asked a second time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def first_within(stream: DataFrame, keys: list[str], ts: str, horizon: str) -> DataFrame:
    """One row of each key; a repeat comes through again only after ``horizon``, when the watermark has removed the key from the state."""
    return stream.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(keys)


class DoneIndex:
    """Done keys in folders ``bucket=<hash>/batch=<number>``. ``buckets`` bounds the files of a batch; for a batch that has keys in all of them
    they make no difference, a small one reads few."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        path = spark._jvm.org.apache.hadoop.fs.Path
        self._path, self._fs = path, path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int")

    def unseen(self, rows: DataFrame, key: str) -> DataFrame:
        """Rows whose key isn't in the index; only the buckets of these rows' keys are read. A null key is a key like any other."""
        if not self._fs.exists(self._path(self.folder)):
            return rows
        mine = [r.b for r in rows.select(self.bucket(F.col(key)).alias("b")).distinct().collect()]  # at most ``buckets``
        known = self.spark.read.schema("fq_known string, bucket int, batch long").parquet(self.folder).where(F.col("bucket").isin(mine))
        return rows.join(known.select("fq_known").distinct(), F.col(key).cast("string").eqNullSafe(F.col("fq_known")), "left_anti")

    def add(self, keys: DataFrame, key: str, batch: int) -> None:
        """The keys of a batch; one that is added again replaces what it had."""
        out = keys.select(F.col(key).cast("string").alias("fq_known"), self.bucket(F.col(key)).alias("bucket"), F.lit(batch).alias("batch")).distinct()
        out.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(self.folder)


def once_stream(stream: DataFrame, key: str, folder: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], buckets: int = 64) -> None:
    """``work`` on the rows of each batch whose key no batch had before, one row of each key, written as table ``b<batch>`` of ``folder``.

    ``work`` returns the key with its results. Of a key's rows in one batch any one is taken."""
    spark = stream.sparkSession
    index = DoneIndex(spark, f"{folder}/_index", buckets)

    def step(batch: DataFrame, number: int) -> None:
        out = f"{folder}/b{number}"
        if not index._fs.exists(index._path(f"{out}/_SUCCESS")):
            work(index.unseen(batch.dropDuplicates([key]), key)).write.mode("overwrite").parquet(out)
        index.add(spark.read.parquet(out), key, number)

    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def classify_stream(frames: DataFrame, folder: str, checkpoint: str, model: str = "people_yes_no") -> None:
    """Frames classified as their files arrive, one table ``b<batch>`` for each batch, no image asked twice."""
    from framequarry.plans.frames import classify

    once_stream(frames, "image_id", folder, checkpoint, lambda new: classify(new, None, model))

