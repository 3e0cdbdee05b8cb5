"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of failing the parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where a later aggregate then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

#: Of stored and staged files, whose size is mostly text.
COMPRESSION = "zstd"
#: Of lines of text. The default level takes some three times as long for a tenth less.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
SHUFFLE_TARGET_BYTES = 128 * 1024 * 1024
PARQUET_EXPANSION = 4
UNKNOWN_BYTES = 2**62


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shuffle_partitions(*inputs: DataFrame) -> int:
    """How many shuffle partitions fit the inputs, at least as many as are set.

    The size is Catalyst's own estimate of the scans (file listing only, no job); sources of unknown
    size do not count. AQE merges what turns out too small, but cannot add partitions it was not given.
    """
    size = 0
    for df in inputs:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
        size += sum(s for s in sizes if s < UNKNOWN_BYTES)
    current = int(inputs[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(size * PARQUET_EXPANSION // SHUFFLE_TARGET_BYTES, current)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a result's size: near for stored, staged and cached rows, far above for joins."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


@contextmanager
def sized_shuffles(*inputs: DataFrame) -> Iterator[int]:
    """Run a job with shuffle partitions that fit its inputs; the session's setting comes back."""
    conf, key = inputs[0].sparkSession.conf, "spark.sql.shuffle.partitions"
    before, wanted = conf.get(key), shuffle_partitions(*inputs)
    conf.set(key, str(wanted))
    try:
        yield wanted
    finally:
        conf.set(key, before)


@cache
def _local_root() -> str:
    return f"file://{tempfile.mkdtemp(prefix='editstream-')}"


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_made: dict[str, SparkSession] = {}


@atexit.register
def _remove_scratch() -> None:
    """Results are read from scratch folders for as long as the process lives, and no longer."""
    for path, spark in _made.items():
        with suppress(Exception):  # the JVM may be gone by now
            remove_folder(spark, path)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    It goes when the process ends. Only a local session may lack that setting; it uses a folder of
    this machine. On a cluster other executors could not read such a folder, so there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{(shared or _local_root()).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made[path] = spark
    return path


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a job that is run inside go when it ends.

    By default they stay until the driver happens to collect its garbage, so those of job after job
    lie on the executors' disks. For writes, whose plan is not run a second time.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The rows of ``df``, written once to the scratch folder and read from there.

    What follows does not repeat the work behind ``df``, and a lost executor costs the repeat of
    its own tasks only. Being a table, it also has a known size, by which Spark can choose to
    broadcast it. The folder is removed afterwards.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    try:
        with freed_shuffles(spark):
            df.write.option("compression", COMPRESSION).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, staged for a result that is read after the call; gone with the process."""
    path = scratch_dir(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
