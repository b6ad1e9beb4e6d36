"""Tables that change together, by numbered commits (K1, K2, H7).

A folder holds data folders and ``_log/<number>.json``. A commit file names the data folders of every table as they are after it,
so one file is one state of all tables. It is put there whole and only if no file of that number exists; that is the one
step in which writers meet. Everything a writer does before it is invisible, everything after it is whole: a frame and its
video's ``done`` appear together or not at all.

A writer starts from a snapshot. If another one has committed meanwhile, changes that only add rows go on top; changes
that read a table which the other one has touched are made again from the new snapshot. So no key is lost or written twice.
The folder must be on a file system that all executors reach. Where it is HDFS, a rename that doesn't replace puts the file
in place, on a local or mounted disk a hard link; object stores without either can't be used.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framequarry.operators.dedup import keep_first
from framequarry.scratch import delete


def _columns(table: dict) -> list[tuple[str, str]]:
    return [(f["name"], json.dumps(f["type"])) for f in table["schema"]["fields"]]


class Conflict(Exception):
    """Other writers were faster more often than the writer wanted to try."""


@dataclass(frozen=True)
class Change:
    """What a commit does to a table: ``add`` rows, ``upsert`` rows whose key is unseen (of rows with one key the first by ``order``), or
    ``replace`` all rows."""

    rows: DataFrame
    how: str = "add"
    key: str | None = None
    order: str | None = None


@dataclass(frozen=True)
class Snapshot:
    """All tables as one commit left them; version 0 is before the first one."""

    log: CommitLog
    version: int = 0
    tables: dict = field(default_factory=dict)
    batches: dict = field(default_factory=dict)

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def table(self, name: str) -> DataFrame:
        t = self.tables[name]
        return self.log.spark.read.schema(T.StructType.fromJson(t["schema"])).parquet(*(f"{self.log.folder}/{p}" for p in t["parts"]))

    def unseen(self, name: str, rows: DataFrame, key: str, order: str | None = None) -> DataFrame:
        """Of ``rows`` those whose key table ``name`` doesn't have, one of each key, the first by ``order``. Only the table's keys are read; null is a key like any other."""
        first = keep_first(rows, [key], [order or key])
        if name not in self:
            return first
        known = self.table(name).select(F.col(key).alias("fq_known")).distinct()
        return first.join(known, F.col(key).eqNullSafe(F.col("fq_known")), "left_anti").select(*rows.columns)


class CommitLog:
    def __init__(self, spark: SparkSession, folder: str, csv: bool = False):
        """With ``csv`` every part of a table is written as CSV too, under the same commit."""
        self.spark, self.folder, self.csv = spark, folder.rstrip("/"), csv
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        root = self._path(self.folder)
        self._fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.folder}/_log"))
        real = self._fs.resolvePath(root).toUri()
        #: The folder's path on a disk of this machine, if it is there.
        self._disk = real.getPath() if (real.getScheme() or "file") == "file" else None

    def _entry(self, version: int) -> str:
        return f"{self.folder}/_log/{version:020d}.json"

    def versions(self) -> list[int]:
        found = self._fs.globStatus(self._path(f"{self.folder}/_log/*.json")) or []
        return sorted(int(f.getPath().getName()[:-5]) for f in found)

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The state after the last whole commit, or after commit ``version``."""
        last = self.versions()[-1:] if version is None else [version]
        if not last or last == [0]:
            return Snapshot(self)
        stream = self._fs.open(self._path(self._entry(last[0])))
        try:
            entry = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        return Snapshot(self, last[0], entry["tables"], entry["batches"])

    def _claim(self, version: int, entry: dict) -> bool:
        """Puts commit ``version`` in place, whole; false if there is one."""
        part = f"{self.folder}/_log/.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(part), False)
        try:
            out.write(bytearray(json.dumps(entry).encode()))
        finally:
            out.close()
        try:
            if self._disk is None:
                return bool(self._fs.rename(self._path(part), self._path(self._entry(version))))
            try:
                os.link(*(f"{self._disk}/_log/{p.rsplit('/', 1)[1]}" for p in (part, self._entry(version))))
                return True
            except FileExistsError:
                return False
        finally:
            self._fs.delete(self._path(part), False)

    def _write(self, base: Snapshot, changes: dict[str, Change]) -> dict[str, dict]:
        """Writes the rows of all changes; what each table becomes on top of ``base``."""
        out, at = {}, f"data/{uuid.uuid4().hex}"
        for name, change in changes.items():
            rows = change.rows
            if change.how == "upsert":
                rows = base.unseen(name, rows, change.key, change.order)
            elif change.how not in ("add", "replace"):
                raise ValueError(f"unknown change {change.how!r}")
            rows.write.parquet(f"{self.folder}/{at}/{name}")
            if self.csv:
                self.spark.read.schema(rows.schema).parquet(f"{self.folder}/{at}/{name}").write.csv(f"{self.folder}/{at}/{name}.csv", header=True, quote='"', escape='"')
            out[name] = {"parts": [f"{at}/{name}"], "schema": json.loads(rows.schema.json()), "how": change.how}
        return out

    def commit(self, build: Callable[[Snapshot], dict[str, Change]], tries: int = 20, batch: tuple[str, int] | None = None, reads: tuple[str, ...] = ()) -> int:
        """Commits what ``build`` makes of a snapshot, several tables at once, and returns the version. ``build`` is called again when
        another writer has changed a table that this commit upserts or replaces, or one named in ``reads``. ``batch`` names a
        stream and its batch: a batch that was committed before is left alone. No changes are no commit."""
        base = self.snapshot()
        for _ in range(tries):
            if batch and base.batches.get(batch[0], -1) >= batch[1]:
                return base.version
            changes = build(base)
            if not changes:
                return base.version
            written = self._write(base, changes)
            depends = {*reads, *(n for n, t in written.items() if t["how"] != "add")}
            now = base
            while True:
                if batch and now.batches.get(batch[0], -1) >= batch[1]:
                    break
                tables = dict(now.tables)
                for name, t in written.items():
                    before = tables[name]["parts"] if name in tables and t["how"] != "replace" else []
                    if before and _columns(tables[name]) != _columns(t):
                        raise ValueError(f"rows of {name} have another schema than the table")
                    tables[name] = {"parts": [*before, *t["parts"]], "schema": t["schema"], "changed": now.version + 1}
                batches = {**now.batches, batch[0]: batch[1]} if batch else now.batches
                if self._claim(now.version + 1, {"tables": tables, "batches": batches, "at": time.time()}):
                    return now.version + 1
                now = self.snapshot()
                if any(now.tables.get(n, {}).get("changed", 0) > base.version for n in depends):
                    break
            for t in written.values():
                delete(self.spark, f"{self.folder}/{t['parts'][0]}")
                delete(self.spark, f"{self.folder}/{t['parts'][0]}.csv")
            base = now
        raise Conflict(f"{tries} tries")

    def compact(self, name: str) -> int:
        """One part in place of the many that a table has after many commits."""
        return self.commit(lambda s: {name: Change(s.table(name), "replace")})

    def vacuum(self, keep: int = 2, older_s: float = 86400.0) -> int:
        """Deletes commits before the last ``keep`` and data folders that no kept commit names, where these are older than ``older_s``
        seconds, as a younger one may belong to a writer that hasn't committed yet. Returns the number of data folders deleted."""
        versions = self.versions()
        for v in versions[:-keep]:
            self._fs.delete(self._path(self._entry(v)), False)
        used = {p.split("/")[1] for v in versions[-keep:] for t in self.snapshot(v).tables.values() for p in t["parts"]}
        gone, oldest = 0, (time.time() - older_s) * 1000
        for f in self._fs.globStatus(self._path(f"{self.folder}/data/*")) or []:
            if f.getPath().getName() not in used and f.getModificationTime() <= oldest:
                self._fs.delete(f.getPath(), True)
                gone += 1
        return gone


def portions(batch: DataFrame, key: str, rows: int) -> list[DataFrame]:
    """``batch`` in portions of about ``rows`` rows by a hash of the key, the same ones each time."""
    n = -(-batch.count() // rows)
    return [batch.where(F.pmod(F.xxhash64(key), F.lit(n)) == k) for k in range(n)]


def commit_stream(stream: DataFrame, log: CommitLog, app: str, checkpoint: str, build: Callable[[DataFrame, Snapshot], dict[str, Change]], key: str | None = None, every: int | None = None) -> None:
    """Commits a stream's batches, in portions of about ``every`` rows where that is given, so that a crash costs the work of one portion at most.

    A batch that Spark runs again finds its committed portions in the log and makes only the rest."""

    def step(batch: DataFrame, number: int) -> None:
        parts = portions(batch, key, every) if key and every else [batch]
        for k, part in enumerate(parts):
            log.commit(lambda s, part=part: build(part, s), batch=(app, (number << 32) + k))

    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
