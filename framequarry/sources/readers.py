"""Sources (S1-S18, S21): every reader returns a DataFrame with an explicit schema and, where order matters, an ordinal."""

from __future__ import annotations

import json
import os
import tomllib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framequarry import schemas
from framequarry.functions import ids
from framequarry.functions.text import strip
from framequarry.operators.dedup import keep_first, last_wins
from framequarry.sources import files


def file_order() -> Column:
    """What tells the order of a scan's rows: file, then block of the file, then row. Spark deals files out by size, so a
    running number alone doesn't follow the files' order."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """line and ord; ord follows the files' paths and the position in them."""
    return spark.read.text(path).select(F.col("value").alias("line"), file_order().alias("ord"))


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """Ids of a list of ids and addresses, first seen first; blank lines and comments are skipped."""
    raw = lines(spark, path).where(~F.trim("line").startswith("#") & (F.trim("line") != ""))
    found = raw.select(ids.id_from_line(F.col("line")).alias("id"), "ord").where("id is not null")
    return keep_first(found, ["id"], ["ord"])


def playlist(spark: SparkSession, path: str) -> DataFrame:
    """The playlist dimension, texts stripped; of a repeated id the later row counts, and a missing address is made from the id."""
    raw = spark.read.csv(path, sep="\t", header=True, schema=schemas.PLAYLIST, quote="").withColumn("ord", file_order())
    raw = raw.withColumns({c: strip(F.col(c)) for c in ("id", "title", "url")}).withColumn("url", F.nullif("url", F.lit("")))
    return last_wins(raw.where("id <> ''"), ["id"], ["ord"]).drop("ord").withColumn("url", ids.default_url(F.col("url"), F.col("id")))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of a ledger: the last word of lines with two or more."""
    words = F.filter(F.split(F.trim("value"), r"\s+"), lambda x: x != "")
    return spark.read.text(path).select(words.alias("w")).where(F.size("w") >= 2).select(F.element_at("w", -1).alias("id")).distinct()


def id_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("id")).where("id <> ''").distinct()


def listing(spark: SparkSession, folder: str, glob: str, recursive: bool = False) -> DataFrame:
    """path, name and size of files, hidden and partial ones left out; contents aren't read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return found.select("path", ids.basename(F.col("path")).alias("name"), F.col("length").alias("size")).where(~F.col("name").startswith(".") & ~F.col("name").endswith(".part"))


def image_bytes(spark: SparkSession, folder: str, glob: str = "*.jpg", recursive: bool = False) -> DataFrame:
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return found.select(ids.basename(F.col("path")).alias("name"), F.col("content").alias("bytes"))


def csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, multiLine=True, quote='"', escape='"')


def csv_strings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False)


def jsonl(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """One JSON object a line; a bad line fails the read if strict, else it is left out."""
    return spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")


def jsonl_map(spark: SparkSession, path: str, key: str, value: str, schema: T.StructType) -> DataFrame:
    """key and value, the last line of each key, files in the order of their paths."""
    raw = jsonl(spark, path, schema, strict=False).withColumn("ord", file_order())
    return last_wins(raw.where(F.col(key).isNotNull()), [key], ["ord"]).select(key, value)


def status_table(spark: SparkSession, folder: str) -> DataFrame:
    """video_id and status of marker files ``<id>.done`` and ``<id>.failed``.

    Markers are empty files, which scans leave out, so they are listed, by tasks for ``files`` and else, for file systems that only
    Hadoop knows, by the driver. A status table in place of markers needs no listing.
    """
    if files.known(folder):
        return files.markers(spark, folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.{{done,failed}}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    names = spark.createDataFrame([(f.getPath().getName(),) for f in found or [] if not f.getPath().getName().startswith(".")], "name string")
    return names.select(F.regexp_extract("name", r"^(.*)\.(done|failed)$", 1).alias("video_id"), F.regexp_extract("name", r"\.(done|failed)$", 1).alias("status"))


def attempts(spark: SparkSession, path: str) -> DataFrame:
    """id and last attempt of a JSON map; a corrupt or missing map is empty."""
    try:
        raw = spark.read.text(path, wholetext=True)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schemas.ATTEMPTS)
    return raw.select(F.explode(F.from_json("value", "map<string,double>")).alias("id", "ts"))


def known_ids(*frames: DataFrame) -> DataFrame:
    """Distinct ids of ledgers and listings together."""
    out = frames[0].select("id")
    for f in frames[1:]:
        out = out.unionByName(f.select("id"))
    return out.distinct()


def display_size(probe: DataFrame) -> DataFrame:
    """width and height as displayed: swapped where the rotation is a quarter turn."""
    turned = F.abs(F.coalesce("rotation", F.lit(0))) % 180 == 90
    return probe.withColumns({"display_w": F.when(turned, F.col("h")).otherwise(F.col("w")), "display_h": F.when(turned, F.col("w")).otherwise(F.col("h"))})


def valid_download(rc: Column, size: Column, probed: Column, least: int = 65536) -> Column:
    return (rc == 0) & (size >= least) & probed


def queue_stream(spark: SparkSession, folder: str, per_trigger: int = 16) -> DataFrame:
    """Files ``<id>.url`` as they arrive: id and address, at most ``per_trigger`` files a batch."""
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", per_trigger).option("pathGlobFilter", "*.url").load(folder)
    return raw.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.url$", "").alias("id"), F.trim("value").alias("url"))


def config(path: str | None, defaults: dict, env_prefix: str = "FRAMEQUARRY_", overrides: dict | None = None) -> dict:
    """Settings: file below environment below overrides; unknown keys are ignored."""
    out = dict(defaults)
    if path and os.path.exists(path):
        with open(path, "rb") as f:
            out |= {k: v for k, v in tomllib.load(f).items() if k in defaults}
    for k in defaults:
        if (v := os.environ.get(env_prefix + k.upper())) is not None:
            out[k] = v if isinstance(defaults[k], str) else json.loads(v)
    return out | {k: v for k, v in (overrides or {}).items() if k in defaults and v is not None}
