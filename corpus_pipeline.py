"""The corpus pipeline: quality classifier, n-gram Jaccard join, benchmark decontamination, PII, packing.

Each stage takes (spark, docs, sf_dir), works on all rows of its predecessor and returns a DataFrame, which ``run``
writes as Parquet to the cluster's shared folder and reads again. All but the last return the columns of documents.

Every stage: texts are read whole, whatever their length; an empty table gives an empty result; columns beyond those of documents are
dropped, so none can clash. Null and empty texts, ties and repeated rows: the quality stage judges them by what an empty
text looks like, equal rows alike, and keeps all rows if there are no labels of both kinds; the join keeps rows without
words and one of equal rows; decontamination keeps rows without words and judges equal rows alike; the PII stage leaves
null texts null with n_chars 0 and keeps repeated rows; packing makes one piece of one id of a null or empty text and
packs repeated rows as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framequarry.llm.common import Scratch, table
from framequarry.llm.decontamination import find_windows
from framequarry.llm.jaccard import near_duplicates
from framequarry.llm.packing import pack_documents, tokenizer_path
from framequarry.llm.pii import fit_field, redact
from framequarry.llm.quality import fit_quality, score_quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps."""
    docs = docs.select(*COLUMNS)
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels"))).where("kept").select(*COLUMNS)


def sorting_key(docs: DataFrame) -> Column:
    """Text that sorts as doc_id does, whole numbers by value and nulls last, with a hash of the row's text behind it."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    if kind in ("bigint", "int", "smallint", "tinyint"):
        number = F.lpad((F.col("doc_id").cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), 20, "0")
    else:
        number = F.concat(F.lit("="), F.col("doc_id").cast("string"), F.lit("\0"))
    return F.concat(F.coalesce(number, F.lit("none")), F.lit(":"), F.hex(F.xxhash64("text")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id, of repeated rows one; rows without words stay.

    A row is known by its id and a hash of its text, so that two texts under one id are two documents.
    """
    docs = docs.select(*COLUMNS)
    keyed = docs.withColumn("fq_key", sorting_key(docs))
    groups = near_duplicates(keyed, doc_id="fq_key").where("component_id = doc_id").select(F.col("doc_id").alias("fq_key")).distinct()
    return keyed.join(groups, "fq_key", "left_semi").dropDuplicates(["fq_key"]).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    docs = docs.select(*COLUMNS)
    hit = find_windows(docs, table(spark, sf_dir, "benchmark")).where("n_hit > 0").select(F.col("doc_id").alias("hit_id"), "text_hash").distinct()
    at = docs.doc_id.eqNullSafe(hit.hit_id) & (F.xxhash64("text") == hit.text_hash)
    return docs.join(hit, at, "left_anti").select(*COLUMNS)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and n_chars counted anew."""
    docs = docs.select(*COLUMNS)
    return redact(docs, fit_field(docs)).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0).cast("long"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return pack_documents(docs, tokenizer_path(), with_ids=False)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", one_of_each_group), ("benchmark decontamination", decontaminate), ("PII", private), ("packing", pack)]

#: Stages fit classifiers and tokenise, which SQL can't express; tests hold them against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark), table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        before, docs = docs, scratch.write(stage(spark, docs, sf_dir))
        scratch.drop(before)  # the stage is written, nothing reads its input any more
    return docs
