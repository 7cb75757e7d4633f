"""Delimited files in batch folders: ``<root>/batch_N/<entity>.csv``, a file or a folder of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.batches import batch_of_path

LINEAGE = ["_source_file", "_ingested_at", "_batch_id"]


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def batch_glob(root: str, entity: str, batch: str = "batch_*") -> str:
    return f"{root.rstrip('/')}/{batch}/{entity}.csv"


def with_lineage(df: DataFrame) -> DataFrame:
    """Adds source file, time of ingest and batch; call it right on a file scan or stream."""
    path = F.col("_metadata.file_path")
    return df.select(
        "*",
        path.alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
        batch_of_path(path).alias("_batch_id"),
    )


def read_batches(
    spark: SparkSession, root: str, entity: str, columns: Sequence[str], batch: str = "batch_*"
) -> DataFrame:
    """All batches of an entity as text with lineage.

    The schema is given, so no pass over the files infers one, and a file whose header names
    other columns stops the job instead of shifting values.
    """
    rows = (
        spark.read.schema(text_schema(columns))
        .options(header=True, enforceSchema=False)
        .csv(batch_glob(root, entity, batch))
    )
    return with_lineage(rows)


# Rows of a packed file, which one task reads as a whole.
PACKED_ROWS = 1_000_000


def write_batch(df: DataFrame, root: str, entity: str, batch: str, packed: bool = False) -> None:
    """Rows as one batch of an entity, every value as text; ``packed`` as gzip files."""
    packing = {"compression": "gzip", "maxRecordsPerFile": PACKED_ROWS} if packed else {}
    df.write.options(header=True, emptyValue="", **packing).csv(batch_glob(root, entity, batch))
