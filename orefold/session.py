"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Limits, each overridden by the Spark setting of this name.
LIMITS = {
    # A key with more rows than this is taken out of the ordinary window or join
    # and spread over many tasks.
    "spark.orefold.hotGroupRows": 4_000_000,
    # A lookup side measured below this many bytes is broadcast.
    "spark.orefold.broadcastBytes": 64 << 20,
    # The same for the list of hot keys, which rows must meet before they are
    # shuffled by key.
    "spark.orefold.hotListBytes": 64 << 20,
    # Lines that are shuffled at once where a wide table is stored.
    "spark.orefold.linesAtOnce": 50_000_000,
}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    # Where every partition of a lookup side is small enough to hash, the other
    # side need not be sorted for the join.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Beyond this size the JVM does not compile a method; rows then go through operators one by one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Without call-site tracking a column expression costs the driver less.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Bytes of a shuffle that one partition should carry.
PARTITION_BYTES = 64 << 20
# Largest shuffle a session expects unless told otherwise.
SHUFFLE_BYTES = 256 << 30


def build_session(app: str = "orefold", master: str | None = None, shuffle_bytes: int = SHUFFLE_BYTES, **extra: str) -> SparkSession:
    """A session with the settings the jobs expect; ``extra`` wins over them.

    Adaptive execution merges small shuffle partitions but never makes more of them,
    so shuffles start with one per ``PARTITION_BYTES`` of ``shuffle_bytes``, the
    size of the largest shuffle to come. A number of shuffle partitions in ``extra``
    replaces that.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **extra}
    if "spark.sql.shuffle.partitions" not in extra:
        wide = str(max(1, -(-shuffle_bytes // PARTITION_BYTES)))
        settings = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": wide, **settings}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def limit(spark: SparkSession, name: str) -> int:
    key = f"spark.orefold.{name}"
    return int(spark.conf.get(key, str(LIMITS[key])))


def at_once(spark: SparkSession, *builders: Callable[[], Any]) -> list:
    """Build independent tables (or find out independent things) side by side, so their jobs fill each other's gaps."""
    with ThreadPoolExecutor(len(builders)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(b)) for b in builders]]


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors do not see the driver's disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="orefold-"))
    return context.getCheckpointDir().rstrip("/")


def _own_scratch(spark: SparkSession) -> str:
    return f"{scratch_folder(spark)}/orefold-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder of this application."""
    return f"{_own_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """File system and path object, for the few file operations Spark has no API for."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    files, folder = hadoop_path(spark, path)
    files.delete(folder, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a query go when it ends, not when the driver collects its garbage.

    For queries that run once, such as writes; threads may be within side by side.
    """
    with _cleaning:
        depth, before = getattr(spark, "_orefold_dropping", (0, None))
        if not depth:
            before = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
        spark._orefold_dropping = depth + 1, before
    try:
        yield
    finally:
        with _cleaning:
            depth, before = spark._orefold_dropping
            if depth == 1:
                spark.conf.set(_CLEANUP, before)
            spark._orefold_dropping = depth - 1, before


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application stashed; tables built on it can no longer be read."""
    files, folder = hadoop_path(spark, _own_scratch(spark))
    files.delete(folder, True)


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage and fixes values that depend on task numbers. Parquet
    rather than ``checkpoint()``: readers prune columns, and the planner knows
    the true size when it decides on a broadcast.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
