"""Intermediate tables in the cluster's shared folder.

A job that has to read the same rows twice and get the same answer (range slices, say) writes
them once and goes on from the written table. That also cuts the lineage, so a lost executor
costs a re-read and not a recomputation.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from strata.sources import store

_FALLBACK = "strata.scratch.dir"
# Applications and folders that were found to be shared.
_tried: set[tuple[str, str]] = set()
# Folders that the innermost ``passing`` block around has to delete.
_passing: ContextVar[list[str] | None] = ContextVar("_passing", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one in the warehouse; in local mode a temporary one.

    A path in a machine's own file system may be mounted on all machines or lie on each of them
    alone, which its name does not tell. On a cluster that is tried out, once per application.
    """
    on_cluster = not spark.sparkContext.master.startswith("local")
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared and on_cluster:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/strata-scratch"
    if shared:
        shared = shared.rstrip("/")
        if on_cluster and (shared.startswith("file:") or "://" not in shared and _local_by_default(spark)):
            _require_shared(spark, shared)
        return shared
    own = spark.conf.get(_FALLBACK, None)
    if own is None:
        own = tempfile.mkdtemp(prefix="strata-")
        spark.conf.set(_FALLBACK, own)
    return own


def _local_by_default(spark: SparkSession) -> bool:
    settings = spark._jsc.hadoopConfiguration()
    return settings.get("fs.defaultFS", "file:///").startswith("file:")


def _require_shared(spark: SparkSession, folder: str) -> None:
    """An error if rows that executors write to ``folder`` are not all there for the driver.

    Without it they would be lost in silence: the driver commits only the files that it sees.
    """
    application = spark.sparkContext.applicationId
    if (application, folder) in _tried:
        return
    tasks = spark.sparkContext.defaultParallelism
    rows, trial = spark.range(0, tasks, 1, tasks), f"{folder}/{application}/trial-{uuid.uuid4().hex}"
    rows.write.parquet(trial)
    if spark.read.schema(rows.schema).parquet(trial).count() != tasks:
        raise ValueError(f"{folder} is not the same folder on all machines; set spark.checkpoint.dir")
    _tried.add((application, folder))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses."""
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written rows."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if (folders := _passing.get()) is not None:
        folders.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that are written inside are deleted at the end of the block.

    For a job that has stored its result by then: no DataFrame that reads such a table may be used
    after it. Tables that were written before the block, or in an inner one, are not its own.
    """
    folders: list[str] = []
    outer = _passing.set(folders)
    try:
        yield
    finally:
        _passing.reset(outer)
        for folder in folders:
            store.delete(spark, folder)


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; call it when all results are written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(
        f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"
    )
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
