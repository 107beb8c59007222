"""Session builder and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on; everything else is left to the cluster.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs the following aggregate a shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # no call-site lookup per column expression: it doubles the time a large plan takes to build
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # stream state on disk, so that its size is not bounded by the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


#: how written Parquet is compressed: about a quarter smaller than Spark's default
PACKED = "zstd"


def build_session(
    app: str = "tidemart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """``shuffle_partitions`` is the number before AQE merges small ones: choose it for the
    largest shuffle, about its bytes over 128 MB."""
    if shuffle_partitions:
        conf = {"spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="tidemart-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver may fall back to the machine's own
    temporary folder; that one is removed when the process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = _own_folder()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, Path) of a location, for existence checks, renames and deletes."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    return fs.exists(jpath)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own: a finished stage, or a partition that has become empty."""
    fs, jpath = hadoop_path(spark, path)
    fs.delete(jpath, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another; repeating it after a break is harmless."""
    fs, src = hadoop_path(spark, source)
    if not fs.exists(src):
        return
    _, dst = hadoop_path(spark, target)
    if fs.exists(dst):
        fs.delete(dst, True)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"cannot move {source} to {target}")


def leaf_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Names (a=1/b=2) of the partition folders so many levels below ``path``."""
    names = [""]
    for _ in range(depth):
        found = []
        for name in names:
            fs, folder = hadoop_path(spark, f"{path}/{name}" if name else path)
            below = [f.getPath().getName() for f in fs.listStatus(folder) if f.isDirectory()]
            found += [f"{name}/{n}" if name else n for n in below if "=" in n]
        names = found
    return names


class Scratch:
    """Intermediate tables of one job, written once, read as often as needed, removed at the end.

        with Scratch(spark, "job") as scratch:
            once = scratch.keep(expensive, "name")
    """

    def __init__(self, spark: SparkSession, label: str, codec: str | None = None):
        self.spark, self.base, self.codec = spark, scratch_dir(spark, label), codec

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        writer = df.write.mode("overwrite")
        (writer.option("compression", self.codec) if self.codec else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure) -> None:
        remove_path(self.spark, self.base)
