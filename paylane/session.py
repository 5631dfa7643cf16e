"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Adaptive execution does the runtime planning: partition coalescing, join strategy by measured size, and
# splitting of skewed join partitions, also where the split costs one more shuffle downstream. Tasks that write one bucket
# keep its file open in place of sorting their rows by bucket.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "1",
}

SHARED_DIR = "spark.checkpoint.dir"
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what is run inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def partitions_at_least(spark: SparkSession, n: int) -> None:
    """Have exchanges of the session start from ``n`` partitions, if they start from fewer; small ones are put together again.

    The setting stays, as it is read when a result is computed and not when it is described.
    """
    if n > int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(n))


def is_local(master: str) -> bool:
    """Driver and executors are one process, so that any folder is shared; ``local-cluster`` is not."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Unset is an error, except on a local master, where a fresh temporary folder is set for the session. A path without
    a scheme counts as one of the cluster's default file system.
    """
    shared = spark.conf.get(SHARED_DIR, None)
    if shared:
        return shared.rstrip("/")
    if not is_local(spark.sparkContext.master):
        raise ValueError(f"{SHARED_DIR} must name a folder that driver and executors share")
    shared = tempfile.mkdtemp(prefix="paylane-")
    spark.conf.set(SHARED_DIR, shared)
    return shared


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder, or below the scratch folder of the moment."""
    return f"{_SCRATCH.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_CLEANUPS: ContextVar[list[Callable[[], object]] | None] = ContextVar("cleanups", default=None)


def on_cleanup(action: Callable[[], object]) -> None:
    """Have ``action`` done when the scratch folder of the moment is removed; outside of one, never."""
    if (actions := _CLEANUPS.get()) is not None:
        actions.append(action)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """Everything that is stored inside the block is removed at its end, so nothing read from it may be used afterwards."""
    path = work_dir(spark, name)
    before, actions = _SCRATCH.set(path), _CLEANUPS.set([])
    try:
        yield path
    finally:
        for action in _CLEANUPS.get() or []:
            action()
        _SCRATCH.reset(before)
        _CLEANUPS.reset(actions)
        remove_dir(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back: recomputation ends there, also after lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(table: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A stored table of narrow rows, to be broadcast if it is counted to have no more than ``rows``; else joined by shuffle."""
    return F.broadcast(table) if table.count() <= rows else table


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data through the file system that holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system; none if it is not there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []
