"""Catalog tables dealt out by a key once, so that joins by it move no rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_bucketed(
    df: DataFrame, name: str, by: Sequence[str], buckets: int, sort: Sequence[str] = ()
) -> int:
    """Create or replace the catalog table ``name``, bucketed by ``by``; the number of rows.

    Tables with the same number of buckets by the same columns (and types) are joined, grouped
    and numbered by them where they lie. Each bucket is one file, sorted by ``by`` and ``sort``.
    Choose ``buckets`` so that a bucket is one task's work. All rows of a key are in one bucket:
    measure it first where one may hold a large share of the rows.

    The rows are written as a table of another name, which then takes this one: a job that fails
    leaves the old table, and ``df`` may read it.
    """
    spark, beside = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    # Dealt out as the buckets are, so that each task writes one file.
    placed = df.repartition(buckets, *by)
    writer = placed.write.format("parquet").bucketBy(buckets, *by).sortBy(*by, *sort)
    writer.saveAsTable(beside)
    rows = spark.table(beside).agg(F.count(F.lit(1))).first()[0]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {beside} RENAME TO {name.rpartition('.')[2]}")
    return rows
