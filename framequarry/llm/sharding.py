"""Sharding (7): contiguous shards of nearly equal bytes from global prefix sums of sizes.

Rows are put in one global order, each partition reports its total, a prefix sum over these totals gives every row
the bytes before it, and the byte axis is cut at equal targets: a row goes to the shard in which its midpoint lies.
A shard's size is so within one row of total / shards. Only the columns of ``df`` move; the query passes digests, not texts.

Defined results: a null text has size 1 and the CRC of the empty text; ties and repeated rows stay apart and keep a
stable order by input position; an empty table gives an empty result; existing columns ``shard`` and ``slot`` are
replaced, other columns are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framequarry.llm.common import Scratch, table


def _running(size_at: int, names: list[str]):
    def run(batches):
        part, total, n = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            size = np.asarray(b.column(size_at), dtype=np.int64)
            end = total + np.cumsum(size)
            cols = [*b.columns, pa.array(np.full(len(size), part, np.int32)), pa.array(end - size), pa.array(n + np.arange(len(size), dtype=np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=names)
            if len(size):
                total, n = int(end[-1]), n + len(size)

    return run


def byte_balanced_shards(df: DataFrame, size: str, order: list[str], n_shards: int = 8) -> DataFrame:
    """``df`` with ``shard`` (0 to n_shards - 1, contiguous in ``order``) and ``slot`` (place in the shard, from 0).

    ``size`` names a non-null, positive bigint column. Rows that tie in ``order`` are told apart by input position, so
    one key with any share of the rows is still spread over partitions.
    """
    df = df.drop("shard", "slot")
    scratch = Scratch(df.sparkSession)
    added = [("__fq_part", T.IntegerType()), ("__fq_before", T.LongType()), ("__fq_at", T.LongType())]
    names = [*df.columns, *(n for n, _ in added)]
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in added)])
    keys = [*order, "__fq_mono"]
    dealt = df.withColumn("__fq_mono", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__fq_mono")
    rows = scratch.write(dealt.mapInArrow(_running(df.columns.index(size), names), schema))
    parts = rows.groupBy("__fq_part").agg(F.sum(size).alias("__fq_bytes"), F.count("*").alias("__fq_n"))
    # One row for each partition, so this window is small at any input size.
    sums = parts.selectExpr(
        "__fq_part",
        "sum(__fq_bytes) over (order by __fq_part) - __fq_bytes as __fq_base",
        "sum(__fq_n) over (order by __fq_part) - __fq_n as __fq_first",
        "sum(__fq_bytes) over () as __fq_total",
    )
    placed = rows.join(sums, "__fq_part").withColumns({"__fq_pos": F.col("__fq_first") + F.col("__fq_at"), "shard": F.least(F.lit(n_shards - 1), F.expr(f"(2 * (__fq_base + __fq_before) + {size}) * {n_shards} div (2 * __fq_total)")).cast("int")})
    first = placed.groupBy("shard").agg(F.min("__fq_pos").alias("__fq_start"))  # at most n_shards rows
    out = placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("__fq_pos") - F.col("__fq_start"))
    return out.select(*df.columns, "shard", "slot")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = byte_balanced_shards(digest, "size", ["doc_id"], 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
