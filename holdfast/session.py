"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def shuffle_partitions(input_bytes: int, partition_bytes: int = 256 << 20) -> int:
    """Exchange partitions that keep each task's share of ``input_bytes`` in memory; the
    adaptive planner merges those that come out small."""
    return max(8, -(-input_bytes // partition_bytes))


def build_session(name: str = "holdfast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect.

    ``forceOptimizeSkewedJoin`` lets the adaptive planner split a hot key even where that
    costs one more exchange further on.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session without that
    setting gets a folder of its own; a cluster without it is an error, because executors
    could not read each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="holdfast-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _file_system(spark, path)
    return files.exists(place)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order; none if there is no such folder."""
    place, files = _file_system(spark, path)
    if not files.exists(place):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())


def delete_path(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.delete(place, True)


_stored: list[str] = []
_owner: ContextVar[list[str]] = ContextVar("owner", default=_stored)


@contextmanager
def owned_tables() -> Iterator[list[str]]:
    """Tables stored inside belong to the list it gives, for ``release_stored``."""
    paths: list[str] = []
    token = _owner.set(paths)
    try:
        yield paths
    finally:
        _owner.reset(token)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name, which belongs to whoever owns the tables stored now."""
    path = f"{scratch_root(spark)}/holdfast-{name}-{uuid.uuid4().hex[:12]}"
    _owner.get().append(path)
    return path


def hand_over(paths: list[str]) -> None:
    """Give stored tables to whoever owns those stored now."""
    _owner.get().extend(paths)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several steps read, and return a reader of it.

    Unlike cached blocks the files outlive a lost executor, and later reads prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_stored(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete one run's tables, or without ``paths`` those that no run owns, once nothing
    that reads them is needed any more; returns how many there were."""
    paths = _stored if paths is None else paths
    count = len(paths)
    while paths:
        delete_path(spark, paths.pop())
    return count
