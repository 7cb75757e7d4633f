"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

from strata.scratch import scratch_root


def build_session(
    app_name: str = "strata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with adaptive execution, UTC and columnar Python exchange.

    On a cluster leave ``shuffle_partitions`` unset and give
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` a value of two to three
    times the executor cores: adaptive execution merges what turns out too small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def thrifty_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark``, with its settings, for runs of many jobs that hand on tables.

    The shuffle files of a job are deleted when it ends; otherwise they stay until the driver's
    memory is cleaned, which may be never. Tables are packed by zstd where ``spark`` has Spark's
    own codec. The settings of ``spark`` itself stay as they are.
    """
    scratch_root(spark)  # a temporary folder is to be the same one for both
    session = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    session.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    if session.conf.get("spark.sql.parquet.compression.codec") == "snappy":
        session.conf.set("spark.sql.parquet.compression.codec", "zstd")
    return session
