"""Files as a Spark data source (K6, S4, S5, S15): listing in tasks, and a sink whose files appear only once all are whole.

Both reach the files through pyarrow's file systems, so ``folder`` is a path of a shared disk or a URI that pyarrow knows (file, hdfs, s3, gs);
nothing lies on an executor's own disk in between.

Reading: the driver sees the folders at the first level only and deals them out; tasks list what is below, empty files
included, without opening any. Writing: a task writes its files into a folder of its own attempt below ``_parts``; when all
tasks have ended the files are moved into place, and where one failed for good its job's folder is removed, so that
neither a failed job nor a second attempt leaves a file.
"""

from __future__ import annotations

import fnmatch
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

LISTING = "path string, name string, size long"
ROWS = 10_000


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder.rstrip("/") or "/")


def known(folder: str) -> bool:
    """Whether pyarrow has a file system for this folder."""
    try:
        opened(folder)
    except (pa.ArrowInvalid, OSError):
        return False
    return True


def removed(fs: pafs.FileSystem, folder: str) -> None:
    if fs.get_file_info(folder).type == pafs.FileType.Directory:
        fs.delete_dir(folder)


@dataclass
class Folders(InputPartition):
    """Folders that a task lists whole, or the folder itself without what is in folders below."""

    paths: list[str]
    below: bool


class ListingReader(DataSourceReader):
    def __init__(self, folder: str, glob: str, recursive: bool, tasks: int):
        self.folder, self.glob, self.recursive, self.tasks = folder, glob, recursive, tasks

    def partitions(self) -> list[InputPartition]:
        fs, root = opened(self.folder)
        out: list[InputPartition] = [Folders([root], False)]
        if self.recursive:
            dealt: dict[int, list[str]] = {}
            for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
                if f.type == pafs.FileType.Directory and not f.base_name.startswith(("_", ".")):
                    dealt.setdefault(zlib.crc32(f.path.encode()) % self.tasks, []).append(f.path)
            out += [Folders(p, True) for p in dealt.values()]
        return out

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        fs, _ = opened(self.folder)
        for path in partition.paths:
            found = fs.get_file_info(pafs.FileSelector(path, recursive=partition.below, allow_not_found=True))
            rows = [(f.path, f.base_name, f.size) for f in found if f.type == pafs.FileType.File and fnmatch.fnmatchcase(f.base_name, self.glob) and not f.base_name.startswith(".") and not f.base_name.endswith(".part")]
            for i in range(0, len(rows), ROWS):
                part = list(zip(*rows[i : i + ROWS], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.string()), pa.array(part[1], pa.string()), pa.array(part[2], pa.int64())], names=["path", "name", "size"])


class Listing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "framequarry_listing"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> ListingReader:
        o = self.options
        return ListingReader(o["path"], o.get("glob", "*"), o.get("recursive", "false") == "true", int(o.get("tasks", "64")))


def listing(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = False, tasks: int = 64) -> DataFrame:
    """path, name and size of files, hidden and partial ones left out; at most ``tasks`` tasks share the folders at the first level. A missing folder is empty."""
    spark.dataSource.register(Listing)
    return spark.read.format("framequarry_listing").options(glob=glob, recursive=str(recursive).lower(), tasks=tasks).load(folder)


def markers(spark: SparkSession, folder: str) -> DataFrame:
    """video_id and status of marker files ``<id>.done`` and ``<id>.failed``, which are empty, in ``folder`` or folders of it."""
    status = F.regexp_extract("name", r"^(.*)\.(done|failed)$", 2)
    return listing(spark, folder, recursive=True).where(status != "").select(F.regexp_extract("name", r"^(.*)\.(done|failed)$", 1).alias("video_id"), status.alias("status"))


@dataclass
class Written(WriterCommitMessage):
    folder: str
    names: list[str]


class FileWriter(DataSourceWriter):
    def __init__(self, folder: str):
        self.folder, self.job = folder, uuid.uuid4().hex

    def write(self, rows: Iterator) -> Written:
        fs, root = opened(self.folder)
        mine, names = f"{root}/_parts/{self.job}/{uuid.uuid4().hex}", []
        fs.create_dir(mine, recursive=True)
        for name, content in rows:
            if name is None or content is None:
                continue
            base = posixpath.basename(name)
            if base in ("", ".", ".."):
                raise ValueError(f"no file name: {name!r}")
            with fs.open_output_stream(f"{mine}/{base}") as out:
                out.write(bytes(content))
            names.append(base)
        return Written(mine, sorted(set(names)))

    def commit(self, messages: list) -> None:
        fs, root = opened(self.folder)

        def place(move: tuple[str, str]) -> None:
            source, target = move
            if fs.type_name != "local" and fs.get_file_info(target).type == pafs.FileType.File:
                fs.delete_file(target)
            fs.move(source, target)

        with ThreadPoolExecutor(32) as pool:
            list(pool.map(place, ((f"{m.folder}/{n}", f"{root}/{n}") for m in messages if m for n in m.names)))
        self._clear(fs, root)

    def abort(self, messages: list) -> None:
        fs, root = opened(self.folder)
        self._clear(fs, root)

    def _clear(self, fs: pafs.FileSystem, root: str) -> None:
        removed(fs, f"{root}/_parts/{self.job}")
        if not fs.get_file_info(pafs.FileSelector(f"{root}/_parts", allow_not_found=True)):
            removed(fs, f"{root}/_parts")


class Files(DataSource):
    @classmethod
    def name(cls) -> str:
        return "framequarry_files"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["path"])


def write_files(df: DataFrame, folder: str, name: str = "name", content: str = "bytes") -> None:
    """Each row's bytes as a file of ``folder``, put in place when all are whole. Rows without name or bytes are left out; a file that is there is
    replaced, and of rows with one name any one stays."""
    df.sparkSession.dataSource.register(Files)
    df.select(F.col(name).cast("string").alias("name"), F.col(content).cast("binary").alias("bytes")).write.format("framequarry_files").mode("append").save(folder)
