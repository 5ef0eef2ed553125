"""Cutting lineage: an intermediate result that several consumers share is written once.

The table goes to the shared folder named by ``spark.checkpoint.dir``, so it outlives any
executor, and Spark knows its size when it plans the joins that read it.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_folder: tempfile.TemporaryDirectory | None = None
_written: list[tuple[SparkSession, str]] = []
# The setting by which Spark deletes the shuffle files of a query when it has ended, and not when the driver happens to collect its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[SparkSession, tuple[int, str]] = {}
_freeing_lock = threading.Lock()


class NoSharedFolder(RuntimeError):
    """A cluster session that names no folder all its executors share."""


def checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``, or the one given to ``setCheckpointDir``.
    Without either, a temporary folder serves a master on this machine alone; any other is refused, because each
    executor would write to a disk of its own."""
    global _own_folder
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise NoSharedFolder("set spark.checkpoint.dir to a folder that driver and executors share")
    if _own_folder is None:
        _own_folder = tempfile.TemporaryDirectory(prefix="tallyweave-")
    return _own_folder.name


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder; what is written there goes when the process ends."""
    path = f"{checkpoint_folder(spark)}/tallyweave/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files behind. The session's own setting holds again when the last of several threads is through."""
    with _freeing_lock:
        threads, own = _freeing.get(spark) or (0, spark.conf.get(FREE_SHUFFLES, "false"))
        _freeing[spark] = threads + 1, own
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            threads, own = _freeing.pop(spark)
            if threads > 1:
                _freeing[spark] = threads - 1, own
            else:
                spark.conf.set(FREE_SHUFFLES, own)


def stage(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of the written table. What it shuffled for that is deleted: nothing reads it again."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with shuffles_freed(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session or its gateway is gone; the folder's own retention applies
        pass


def release(keep: int = 0) -> None:
    """Delete the tables this process has staged, but for the first ``keep``. Frames built on them can no longer be read."""
    while len(_written) > keep:
        _delete(*_written.pop())


class Stages:
    """The staged tables of one owner, which go together."""

    def __init__(self) -> None:
        self._own: list[tuple[SparkSession, str]] = []

    def stage(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        before = len(_written)
        rows = stage(df, name, compression)
        self._own += _written[before:before + 1]
        return rows

    def release(self) -> None:
        while self._own:
            entry = self._own.pop()
            _delete(*entry)
            if entry in _written:
                _written.remove(entry)


@contextmanager
def staged_tables() -> Iterator[None]:
    """Owns what is staged inside: the tables go when the block ends, so a long-lived driver does not fill the shared folder."""
    before = len(_written)
    try:
        yield
    finally:
        release(before)


atexit.register(release)
