"""Positional numbering at scale, shards, batches, limits and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framequarry.scratch import Scratch


def numbered(df: DataFrame, *order: str, name: str = "pos") -> DataFrame:
    """``df`` with its position from 0 by unique keys ``order`` of any type, without one task that sees all rows.

    Rows are dealt out by ranges of ``order`` and sorted within them, once, into a table between steps; every range then
    starts after the rows of the ranges before it. Nulls come first. The result doesn't depend on where ranges end.
    """
    id_ = F.monotonically_increasing_id()  # the partition in the upper bits, the row in it in the lower 33
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = Scratch(df.sparkSession).write(sorted_.withColumns({"fq_part": F.shiftright(id_, 33), "fq_at": id_.bitwiseAND(F.lit((1 << 33) - 1))}))
    sizes = placed.groupBy("fq_part").agg(F.count("*").alias("fq_n"))
    before = sizes.select("fq_part", (F.sum("fq_n").over(Window.orderBy("fq_part")) - F.col("fq_n")).alias("fq_before"))  # one row a range
    return placed.join(before, "fq_part").withColumn(name, F.col("fq_before") + F.col("fq_at")).drop("fq_part", "fq_at", "fq_before")


def ceil_shards(df: DataFrame, order: str, shards: int) -> DataFrame:
    """Contiguous shards of ceil(n / shards) rows; the last may be short or empty."""
    placed = numbered(df, order, name="fq_pos")
    per = max(1, -(-placed.count() // shards))
    return placed.withColumn("shard", F.floor(F.col("fq_pos") / per).cast("int")).drop("fq_pos")


def round_robin(df: DataFrame, order: str, shards: int) -> DataFrame:
    return numbered(df, order, name="fq_pos").withColumn("shard", (F.col("fq_pos") % shards).cast("int")).drop("fq_pos")


def hash_shard(key: Column, shards: int) -> Column:
    """Stable shard by CRC-32 of the key's text; it doesn't change when rows come or go."""
    return (F.crc32(key.cast("string").cast("binary")) % shards).cast("int")


def batches(df: DataFrame, order: str, size: int) -> DataFrame:
    """``batch`` and index ``i`` in it, in order."""
    out = numbered(df, order, name="fq_pos")
    return out.withColumns({"batch": F.floor(F.col("fq_pos") / size), "i": (F.col("fq_pos") % size).cast("int")}).drop("fq_pos")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows in an order that depends on seed and key only; each task sends its own first n at most."""
    return df.withColumn("fq_rank", F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")).cast("binary"))).orderBy("fq_rank", key).limit(n).drop("fq_rank")


def pick(df: DataFrame, key: str, sample: int = 0, limit: int = 0, seed: int = 0, shard: tuple[int, int] | None = None) -> DataFrame:
    """Sample, then shard, then limit; 0 is off."""
    out = seeded_sample(df, key, sample, seed) if sample else df
    if shard:
        out = round_robin(out, key, shard[1]).where(F.col("shard") == shard[0]).drop("shard")
    return out.orderBy(key).limit(limit) if limit else out


def admit(df: DataFrame, order: str, depth: int, high_water: int, batch: int) -> DataFrame:
    """The first rows that fit below the high-water mark, at most a batch."""
    room = max(0, min(batch, high_water - depth))
    return df.orderBy(order).limit(room)


def admit_weight(df: DataFrame, order: str, weight: str, room: int, name: str = "upto") -> DataFrame:
    """Rows in ``order``, a unique key, while their weights fit into ``room``; ``name`` is the sum up to and with the row.

    Weights are whole numbers from 0 on; null counts as 0. The rows are sorted by ranges once. Prefix sums of the ranges' totals tell which
    ranges begin inside the room; only these are read again, and only the last of them holds rows that are left out.
    """
    id_ = F.monotonically_increasing_id()
    weighed = df.withColumn("fq_weight", F.coalesce(F.col(weight).cast("long"), F.lit(0)))
    placed = Scratch(df.sparkSession).write(weighed.repartitionByRange(order).sortWithinPartitions(order).withColumn("fq_part", F.shiftright(id_, 33)))
    totals = placed.groupBy("fq_part").agg(F.sum("fq_weight").alias("fq_total"))
    before = totals.select("fq_part", (F.sum("fq_total").over(Window.orderBy("fq_part")) - F.col("fq_total")).alias("fq_before"))  # one row a range
    inside = placed.join(F.broadcast(before.where(F.col("fq_before") <= room)), "fq_part")
    run = F.sum("fq_weight").over(Window.partitionBy("fq_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return inside.withColumn(name, F.col("fq_before") + run).where(F.col(name) <= room).select(*df.columns, name)
