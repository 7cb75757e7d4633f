"""A stored history that takes in snapshots without being written anew.

Versions that are closed never change again, so they are only added to. A snapshot reads and
rewrites the open versions.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.history import IS_CURRENT, VALID_FROM, VALID_TO, scd2_fold
from strata.sources import published, store

OPEN, CLOSED = "open", "closed"


def _schema(snapshot: DataFrame, keys, tracked, carried) -> T.StructType:
    stored = published.stored_schema(snapshot.schema)
    named = [stored[n] for n in [*keys, *carried, *tracked]]
    ends = [T.StructField(n, T.DateType()) for n in (VALID_FROM, VALID_TO)]
    return T.StructType([*named, *ends, T.StructField(IS_CURRENT, T.BooleanType())])


def take_snapshot(
    snapshot: DataFrame,
    path: str,
    keys: Sequence[str],
    tracked: Sequence[str],
    carried: Sequence[str],
    effective: str | date,
) -> None:
    """Fold a snapshot (one row per key in it) into the closed history at ``path``.

    See ``scd2_fold``; the history is a published table, with the open versions in one folder
    and every snapshot's newly closed ones in another. One writer per history.
    """
    spark, path = snapshot.sparkSession, path.rstrip("/")
    version = published.latest(spark, path)
    schema = _schema(snapshot, keys, tracked, carried)
    if version.notes.get("schema", schema.jsonValue()) != schema.jsonValue():
        raise ValueError(f"the history was made for {version.notes['schema']}")
    opened = published.rows_of(spark, path, version.folders.get(OPEN, []), schema)
    after = scd2_fold(opened, snapshot, keys, tracked, carried, effective)
    folder = published.new_folder(path)
    placed = after.hint("rebalance", F.col(IS_CURRENT))
    placed.write.partitionBy(IS_CURRENT).parquet(f"{path}/{folder}")

    def part(current: bool) -> list[str]:
        name = f"{folder}/{IS_CURRENT}={str(current).lower()}"
        return [name] if store.exists(spark, f"{path}/{name}") else []

    folders = {OPEN: part(True), CLOSED: [*version.folders.get(CLOSED, []), *part(False)]}
    published.publish(spark, path, folders, {"schema": schema.jsonValue()}, version)
    published.expire(spark, path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All versions of the history."""
    version = published.latest(spark, path)
    if version is published.NONE:
        raise ValueError(f"there is no history at {path}")
    schema = T.StructType.fromJson(version.notes["schema"])
    listed = [f for kind in (OPEN, CLOSED) for f in version.folders[kind]]
    return published.rows_of(spark, path, listed, schema)
