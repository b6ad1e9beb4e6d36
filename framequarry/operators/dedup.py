"""Keep-first, last-wins and first-seen (W4, W5, A9, U6): aggregations of one struct, combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: list[str], how) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), F.struct(*rest).alias("row")) if rest else F.struct(*order)
    picked = df.groupBy(*keys).agg(how(row).alias("fq_row"))
    return picked.select(*(F.col(c) if c in keys else F.col("fq_row.row")[c].alias(c) for c in df.columns))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``, ties by the other columns. Columns need to be orderable.

    A sort aggregate on the keys picks it before and after the shuffle, so one row for each key and task moves.
    """
    return _pick(df, keys, order, F.min)


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _pick(df, keys, order, F.max)


def digest(text: Column) -> Column:
    """SHA-256 of a text as 32 bytes, null for null: what texts are compared and joined by in place of themselves."""
    return F.unhex(F.sha2(text, 256))


def first_seen(df: DataFrame, value: str, order: str) -> DataFrame:
    """Distinct texts with the ordinal at which each is first seen. The key is a digest; of each text one copy a task moves along."""
    seen = df.groupBy(digest(F.col(value)).alias("fq_d")).agg(F.min(order).alias("first_seen"), F.count("*").alias("n"), F.first(value).alias(value))
    return seen.select(value, "first_seen", "n")


def flatten(files: DataFrame, folder: str) -> DataFrame:
    """Files of many folders put into one, the first path of each name (no clobbering): path, name and target."""
    from framequarry.functions.ids import repoint

    return keep_first(files, ["name"], ["path"]).withColumn("target", repoint(folder, F.col("name")))
