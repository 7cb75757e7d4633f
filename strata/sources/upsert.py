"""Tables with one row per key that take in new rows by rewriting only what these touch.

The rows lie in buckets by a hash of the key. A bucket without new rows keeps its files; one with
new rows is merged with them. A table is a published one (see ``sources/published.py``), so all
buckets change at once. What has changed is kept with the version for the layer that follows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.clean import latest_wins, with_keys
from strata.operators.skew import key_hash
from strata.scratch import materialise, passing
from strata.sources import published, store

BUCKET = "_bucket"
CHANGED = "changed"


def upsert(
    new: DataFrame, path: str, keys: Sequence[str], order: Sequence[str | Column], buckets: int = 64
) -> int:
    """Take ``new`` into the table at ``path``, the last row per key by ``order``; rows written.

    ``order`` should be total, over columns that are stored; then neither the order of arrival
    nor rows that come twice make a difference. Rows with a NULL key are left out. The columns,
    the keys and the number of buckets of a table stay; others are refused. One writer a table.
    """
    spark, path, keys = new.sparkSession, path.rstrip("/"), list(keys)
    version = published.latest(spark, path)
    schema = published.stored_schema(new.schema).jsonValue()
    made = {"schema": schema, "keys": keys, "buckets": buckets}
    known = {k: version.notes.get(k, made[k]) for k in made}
    if known != made:
        raise ValueError(f"the table was made with {known}, not with {made}")
    bucket = F.pmod(key_hash(keys), F.lit(buckets)).cast("int")
    placed = with_keys(new, keys).withColumn(BUCKET, bucket)
    with passing(spark):
        arrived = materialise(placed, "upsert")
        # At most one row per bucket comes to the driver.
        touched = [r[0] for r in arrived.select(BUCKET).distinct().collect()]
        if not touched:
            if version is published.NONE:
                published.publish(spark, path, {}, made, version)
            return 0
        listed = [f for b in touched for f in version.folders.get(str(b), [])]
        old = published.rows_of(spark, path, listed, placed.schema)
        merged = latest_wins(old.unionByName(arrived), keys, order)
        folder = published.new_folder(path)
        # Neighbouring keys pack well.
        rows = merged.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, *keys)
        rows.write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
    folders = {**version.folders, **{str(b): [f"{folder}/{BUCKET}={b}"] for b in touched}}

    # Rows that were not there, as they are now.
    mark = F.struct(*[F.col(f"`{c}`") for c in new.columns])
    now = published.rows_of(spark, path, [folder], placed.schema)
    before = old.select(*keys, mark.alias("_before"))
    seen = now.join(before, keys, "left")
    changed = seen.filter(~mark.eqNullSafe(F.col("_before"))).drop("_before", BUCKET)
    kept = published.new_folder(path, CHANGED)
    changed.select(*new.columns).write.parquet(f"{path}/{kept}")
    folders[CHANGED] = [kept]
    published.publish(spark, path, folders, made, version)
    published.expire(spark, path)
    return now.count()


def _schema(version: published.Version, path: str) -> T.StructType:
    if version is published.NONE:
        raise ValueError(f"there is no table at {path}")
    return T.StructType.fromJson(version.notes["schema"])


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the table, one per key."""
    version = published.latest(spark, path)
    schema = _schema(version, path)
    listed = [f for kind, names in version.folders.items() if kind != CHANGED for f in names]
    return published.rows_of(spark, path, listed, schema)


def read_changed(spark: SparkSession, path: str) -> DataFrame:
    """Rows that the last call of :func:`upsert` with new rows has added or changed."""
    version = published.latest(spark, path)
    return published.rows_of(spark, path, version.folders.get(CHANGED, []), _schema(version, path))


def upsert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str | Column],
    buckets: int = 64,
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Take in all available rows of a stream, each micro-batch as ``prepare`` leaves it; then stop."""

    def take(batch: DataFrame, _: int) -> None:
        upsert(prepare(batch), path, keys, order, buckets)

    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def bucket_files(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """Names of the data files of every bucket as the table is now."""
    version = published.latest(spark, path)
    return {
        int(kind): sorted(e.path for f in names for e in store.listed(spark, f"{path}/{f}"))
        for kind, names in version.folders.items()
        if kind != CHANGED
    }
