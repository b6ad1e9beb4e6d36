"""Exact dedup (11): groups of equal texts by progressive refinement, DataFrame operations only.

Two texts are equal when they are identical without the characters of ``SPACES``.

1. Length: bytes without spaces, counted over all rows. A length that one row has alone settles that row.
2. Prefix hash: of rows with a shared length, the first ``prefix`` characters are hashed and counted for each length.
3. Full hash: only rows whose (length, prefix hash) is shared have their whole text hashed, with SHA-256.

Rows learn whether their key is shared from a bitmap of the shared keys' hashes: a table of at most ``BITMAP`` rows of 64 bits, so
it can be broadcast at any input size and no text is shuffled. A bit that two keys share, or a bitmap that fills up at
very large sizes, only means that more rows than needed have their text hashed; groups are formed by full hashes.
What is shuffled after that are digests, counted on the map side; of a group only its best row and its size come back,
and groups of any share of the rows are joined without one task holding them (``join_counted``).

Defined results: a null text equals an empty one and one of spaces only. Of equal texts the row with most code points
stays, then the smallest id, null ids last; of repeated rows, alike in id and length too, exactly one stays. An empty
table gives an empty result. Only ids, texts and columns named in ``carry`` are read, so other columns may have any name;
a carried column named like a result is refused. Texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.llm.common import Scratch, join_counted, table

#: Space and 0x09 to 0x0D.
SPACES = "\x20\x09\x0A\x0B\x0C\x0D"
#: Words of 64 bits in a bitmap: 16 million bits, at most 262,144 rows of two numbers.
BITMAP = 1 << 18
PREFIX = 64
RESULTS = ("doc_id", "keep_id", "group_size", "kept")


def squeezed(text: Column) -> Column:
    """The text without any space; a null text is empty."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _place(key: Column) -> Column:
    return F.pmod(key, F.lit(BITMAP))


def _bit(key: Column) -> Column:
    """One of 64 bits, by other bits of the hash than ``_place`` takes."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(key, 20), F.lit(64)).cast("int"))


def shared_keys(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """The bitmap (fq_at, fq_bits) of the hashes in column ``fq_key`` that two or more rows have."""
    shared = keys.groupBy("fq_key").agg(F.count("*").alias("n")).where("n > 1")
    return scratch.write(shared.groupBy(_place(F.col("fq_key")).alias("fq_at")).agg(F.bit_or(_bit(F.col("fq_key"))).alias("fq_bits")), thin=True)


def maybe_shared(rows: DataFrame, key: Column, bits: DataFrame) -> DataFrame:
    """``rows`` with ``fq_shared``: true for every row whose key is shared, and for few others."""
    keyed = rows.withColumn("fq_key", key).join(F.broadcast(bits), _place(key) == F.col("fq_at"), "left")
    return keyed.withColumn("fq_shared", F.coalesce(F.col("fq_bits").bitwiseAND(_bit(F.col("fq_key"))) != 0, F.lit(False))).drop("fq_key", "fq_at", "fq_bits")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), prefix: int = PREFIX) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id (id of the row that stays), group_size, kept, and the columns of ``carry``."""
    if set(carry) & set(RESULTS):
        raise ValueError(f"columns of these names are results: {RESULTS}")
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("fq_text"), *carry).withColumn("fq_norm", squeezed(F.col("fq_text")))
    by_length = F.xxhash64(F.octet_length("fq_norm"))
    by_prefix = F.xxhash64(F.octet_length("fq_norm"), F.left("fq_norm", F.lit(prefix)))

    lengths = shared_keys(rows.select(by_length.alias("fq_key")), scratch)
    prefixes = shared_keys(maybe_shared(rows, by_length, lengths).where("fq_shared").select(by_prefix.alias("fq_key")), scratch)
    narrow = maybe_shared(rows, by_prefix, prefixes).select(
        F.monotonically_increasing_id().alias("fq_row"), "doc_id", F.coalesce(F.length("fq_text"), F.lit(0)).alias("fq_chars"),
        F.when(F.col("fq_shared"), F.unhex(F.sha2("fq_norm", 256))).alias("fq_full"), *carry,
    )
    narrow = scratch.write(narrow)  # a row's number holds from here on, and no later step reads a text

    alone = narrow.where("fq_full is null").withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    together = narrow.where("fq_full is not null")
    best = F.min(F.struct((-F.col("fq_chars")).alias("c"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("fq_row").alias("row")))
    groups = scratch.write(together.groupBy("fq_full").agg(F.count("*").alias("group_size"), best.alias("fq_best")))
    grouped = join_counted(together, groups, ["fq_full"], "group_size").withColumns({"keep_id": F.col("fq_best.id"), "kept": F.col("fq_row") == F.col("fq_best.row")})
    scratch.drop(lengths, prefixes)
    return alone.unionByName(grouped, allowMissingColumns=True).select(*RESULTS, *carry)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_groups(docs.withColumn("text_sha256", F.sha2(squeezed(F.col("text")), 256)), carry=("text_sha256",))


ORACLE = r"""
with n as (select row_number() over () as r, doc_id, length(coalesce(text, '')) as chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents),
k as (select *, count(*) over (partition by text_sha256) as group_size, row_number() over w as place, first_value(doc_id) over w as keep_id from n
  window w as (partition by text_sha256 order by chars desc, doc_id nulls last, r))
select doc_id, keep_id, cast(group_size as bigint) as group_size, place = 1 as kept, text_sha256 from k
"""
