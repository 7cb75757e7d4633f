"""History kept up to date from a stream of change rows, in any order of arrival."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.clean import with_keys
from strata.operators.history import scd2_history
from strata.operators.skew import HOT_ROWS, key_hash

BUCKET = "_bucket"


def apply_changes(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    sequence: str,
    tracked: Sequence[str],
    carried: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    encoding: str = "half_open",
    untracked: str = "latest",
    buckets: int = 64,
    rows_per_file: int = 1_000_000,
    hot_rows: int = HOT_ROWS,
) -> None:
    """Take in all available change rows, then stop.

    ``target/settings`` keeps what the target was made with; other settings, another number of
    buckets above all, would lose track of keys and are refused.

    ``target/log`` holds every change row and ``target/history`` the versions, both in folders
    by a hash of the key. A micro-batch appends to the log and derives the history of the
    buckets it touches anew from the log. Nothing reads what is being overwritten, so a batch
    that failed half-way or is delivered twice comes out the same. One writer per target.
    Choose ``buckets`` once, so that one bucket's log is a few tasks' work.
    """
    keys, tracked, carried = list(keys), list(tracked), list(carried)
    wanted = list(dict.fromkeys([*keys, *carried, *tracked, sequence, *tiebreak]))
    log_path, history_path = f"{target}/log", f"{target}/history"
    _same_settings(
        stream.sparkSession,
        f"{target}/settings",
        {
            "keys": keys,
            "sequence": sequence,
            "tracked": tracked,
            "carried": carried,
            "tiebreak": list(tiebreak),
            "encoding": encoding,
            "untracked": untracked,
            "buckets": buckets,
        },
    )
    bucket = F.pmod(key_hash(keys), F.lit(buckets)).cast("int")
    # The log is read in the caller's session, with adaptive execution if that has it.
    spark = stream.sparkSession

    def absorb(batch: DataFrame, _: int) -> None:
        rows = with_keys(batch.select(*wanted), [*keys, sequence]).withColumn(BUCKET, bucket)
        # At most one row per bucket comes to the driver.
        sizes = {r[BUCKET]: r["count"] for r in rows.groupBy(BUCKET).count().collect()}
        if not sizes:
            return
        # One file for an ordinary bucket, as many writers as it needs for a hot one.
        writers = [1 + sizes.get(b, 0) // rows_per_file for b in range(buckets)]
        writer = F.pmod(F.xxhash64(*wanted), F.array(*map(F.lit, writers))[F.col(BUCKET)])
        placed = rows.repartition(F.col(BUCKET), writer)
        placed.write.mode("append").partitionBy(BUCKET).parquet(log_path)

        log = spark.read.schema(rows.schema).parquet(log_path)
        history = scd2_history(
            log.filter(F.col(BUCKET).isin(*sizes)),
            keys,
            sequence,
            tracked,
            carried,
            tiebreak,
            encoding,
            untracked,
            hot_rows,
        )
        # Rebalancing merges the small pieces of a bucket and splits those of a hot one.
        whole = history.withColumn(BUCKET, bucket).hint("rebalance", F.col(BUCKET))
        (
            whole.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(history_path)
        )

    query = (
        stream.writeStream.foreachBatch(absorb)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _same_settings(spark: SparkSession, path: str, settings: dict) -> None:
    """Store the settings of a new target; an error if a known one has others."""
    own = json.dumps(settings, sort_keys=True)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        spark.createDataFrame([(own,)], "settings string").coalesce(1).write.parquet(path)
        return
    known = spark.read.parquet(path).first()["settings"]
    if known != own:
        raise ValueError(f"the target was made with {known}, not with {own}")


def read_history(spark, target: str) -> DataFrame:
    """The history kept by :func:`apply_changes`."""
    return spark.read.parquet(f"{target}/history").drop(BUCKET)
