"""Shared pieces: reading a table, samples, joins with hot keys, and small helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.scratch import Scratch, shared_dir

__all__ = ["Scratch", "held_out", "join_counted", "labelled_sample", "look_up", "shared_dir", "spread_sample", "table", "up_to"]


#: Bytes of an Arrow batch. Spark bounds its rows only, and ten thousand long documents are more than a task should hold at once.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Batches to Python end at ``BATCH_BYTES`` from here on, unless the session says less."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).removesuffix("b")
    if now.isdigit() and int(now) > BATCH_BYTES:  # a size in other units is the user's own
        spark.conf.set(name, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 3 is 1; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % 3 == 1


#: Up to so many fractions are gathered and become a filter.
MANY_KEYS = 200


def spread_sample(df: DataFrame, key: Column, per_key: int, order: Column) -> DataFrame:
    """About ``per_key`` rows of each value of ``key``, picked by a hash of the row: a pass counts the keys, a filter
    then keeps the fraction needed, and a window cuts what is left, which is bounded, to ``per_key``. Only keys with more
    rows than are kept anyway have a fraction; where these are many, the fractions are joined as a table."""
    from pyspark.sql import Window

    most = 1.5 * per_key + 50
    counts = df.select(key.alias("__k")).where("__k is not null").groupBy("__k").agg(F.count("*").alias("n"))
    shares = counts.where(F.col("n") > most).select("__k", (F.lit(most) / F.col("n")).alias("__share"))
    found = shares.limit(MANY_KEYS + 1).collect()
    two63 = float(2**63)
    keyed = df.withColumns({"__k": key, "__h": order}).where("__k is not null")
    if len(found) > MANY_KEYS:
        keyed = keyed.join(shares, "__k", "left").withColumn("__share", F.coalesce("__share", F.lit(1.0)))
    else:
        share = F.lit(1.0)
        for r in found:
            share = F.when(F.col("__k") == F.lit(r["__k"]), F.lit(r["__share"])).otherwise(share)
        keyed = keyed.withColumn("__share", share)
    w = Window.partitionBy("__k").orderBy("__h")
    return (
        keyed.where((F.col("__h") / F.lit(two63) + 1) / 2 <= F.col("__share"))
        .withColumn("__rn", F.row_number().over(w))
        .where(F.col("__rn") <= per_key)
        .drop("__k", "__h", "__share", "__rn")
    )


#: Ways in which ``look_up`` deals out a key of the large side.
SALTS = 8


def look_up(large: DataFrame, small: DataFrame, keys: list[str], by: Column, how: str = "inner", nulls: bool = True, few: bool = False) -> DataFrame:
    """``large`` joined with ``small``, which has one row for each value of ``keys``, named alike on both sides and
    compared null-safe unless ``nulls`` is off. A key may hold any share of ``large``: its rows are dealt out by the hash of ``by`` in ``SALTS``
    ways, and the rows of ``small``, which are short, go out once for each way.

    Spark takes a written table to be as small as its compressed files and would broadcast it, once for each way, through the
    driver. So both sides are shuffled and merged, unless ``small`` has ``few`` rows however large the input is."""
    left = large.withColumn("fq_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    right = small.withColumnsRenamed({k: f"fq_{k}_" for k in keys}).withColumn("fq_salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    right = right if few else right.hint("merge")
    at = F.col("fq_salt") == F.col("fq_salt_")
    for k in keys:
        at &= F.col(k).eqNullSafe(F.col(f"fq_{k}_")) if nulls else F.col(k) == F.col(f"fq_{k}_")
    return left.join(right, at, how).drop("fq_salt", "fq_salt_", *(f"fq_{k}_" for k in keys))


#: ``join_counted`` broadcasts the keys that hold more than one in so many of all rows; there are fewer than this of them.
HOT_SHARE = 10_000


def join_counted(large: DataFrame, small: DataFrame, keys: list[str], n: str) -> DataFrame:
    """``large`` inner joined with ``small``, null-safe on ``keys``. ``small`` has one row for each value of the keys and in column
    ``n`` the number of rows of ``large`` that have it. Keys with more than one in ``HOT_SHARE`` of all rows, which are
    fewer than ``HOT_SHARE`` at any size, are broadcast, so their rows stay where they are; all others go by a shuffle
    in which no key is large. Both sides are read twice and should be written tables."""
    total = small.agg(F.sum(n)).first()[0] or 0
    right = small.withColumnsRenamed({k: f"fq_{k}_" for k in keys})
    at = F.lit(True)
    for k in keys:
        at &= F.col(k).eqNullSafe(F.col(f"fq_{k}_"))
    is_hot = F.col(n).cast("decimal(38,0)") * HOT_SHARE > F.lit(int(total)).cast("decimal(38,0)")
    hot, rest = F.broadcast(right.where(is_hot)), right.where(~is_hot)
    there = large.join(F.broadcast(right.where(is_hot).select(*(f"fq_{k}_" for k in keys))), at, "left_anti").join(rest, at)
    return large.join(hot, at).unionByName(there).drop(*(f"fq_{k}_" for k in keys))


def up_to(rows: DataFrame, key: Column, text: str, order: Column, usual: int, budget: int, size: Column | None = None) -> DataFrame:
    """Of a bounded sample the rows of each ``key`` that fit into ``budget`` characters of ``text`` in all: those of at most
    ``usual`` characters first, by ``order``, then longer ones from the shortest on. So a few long texts neither take
    the place of many others nor are left out for their length while there is room. ``size`` stands in where the rows have
    no text but its length."""
    from pyspark.sql import Window

    size = F.length(text).cast("long") if size is None else size
    w = Window.partitionBy(key).orderBy(F.greatest(size, F.lit(usual)), order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("fq_chars", F.sum(size).over(w)).where(F.col("fq_chars") <= budget).drop("fq_chars")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, usual: int, budget: int, doc_id: str = "doc_id", text: str = "text", extra: tuple[str, ...] = ()) -> list:
    """Collected rows (doc_id, text, label, extra columns), one of each id, at most about ``per_class`` of each label 0 and 1, and at
    most ``budget`` characters of each (see ``up_to``).

    The ids are picked from the labels first, so only this bounded set of ids is broadcast. An id that many rows have is
    one row of the sample, the one whose text has the smallest hash; this is settled on hashes and lengths, before a text
    is taken. Of a repeated label the largest counts."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(label).alias("fq_label"))
    ids = spread_sample(known, F.col("fq_label"), per_class, F.xxhash64(doc_id))
    usable = docs.where(F.col(text).isNotNull() & (F.length(text) <= budget)).select(doc_id, text, *extra)
    by = F.xxhash64(doc_id, text)
    seen = usable.join(F.broadcast(ids), doc_id).select(doc_id, "fq_label", by.alias("fq_by"), F.length(text).cast("long").alias("fq_size"))
    one = seen.groupBy(doc_id, "fq_label").agg(F.min(F.struct("fq_by", "fq_size")).alias("m")).select(doc_id, "fq_label", "m.*")
    chosen = up_to(one, F.col("fq_label"), text, F.col("fq_by"), usual, budget, F.col("fq_size")).select(F.col(doc_id).alias("fq_id"), "fq_label", "fq_by")
    rows = usable.join(F.broadcast(chosen), (F.col(doc_id) == F.col("fq_id")) & (by == F.col("fq_by"))).drop("fq_id")
    picked = rows.groupBy(doc_id, "fq_label", "fq_by").agg(F.first(text).alias(text), *(F.min(c).alias(c) for c in extra))
    return picked.select(doc_id, text, *extra, "fq_label", "fq_by").orderBy("fq_by", doc_id).drop("fq_by").collect()
