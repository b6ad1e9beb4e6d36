"""Tables between steps in the cluster's shared folder (that of spark.checkpoint.dir), and their removal."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which every executor can reach. Where none is set, a local master gets a temporary
    one (tests); any other master is an error, since its executors share no local folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = current.get() if current.isDefined() else None
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-", dir="/tmp"))
        found = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return found


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Tables written to the shared folder: they cut the lineage, survive lost executors and are read back by Spark.

    ``drop`` deletes tables that no later plan reads, so that the disk holds only what is still needed. What a returned
    frame still reads stays until ``close`` or until the driver's Python process ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/framequarry-{uuid.uuid4().hex}"
        self.n = 0
        self.paths: dict[int, str] = {}
        _open.append(self)

    def write(self, df: DataFrame, thin: bool = False) -> DataFrame:
        """``thin`` is for tables far smaller than the input: a sixteenth as many tasks and files as shuffles have."""
        if thin:
            df = df.coalesce(max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // 16))
        self.n += 1
        path = f"{self.root}/t{self.n}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            path = self.paths.pop(id(df), None)
            if path:
                delete(self.spark, path)

    def close(self) -> None:
        """Deletes all that is left; frames that still read it can't be used afterwards."""
        self.paths.clear()
        delete(self.spark, self.root)
        if self in _open:
            _open.remove(self)


_open: list[Scratch] = []


@atexit.register
def _close_all() -> None:
    for scratch in list(_open):
        try:
            scratch.close()
        except Exception:  # the session has ended already; its folder is the cluster's to clear
            return
