"""Stored tables: whole-table refresh that readers never see half done, catalog tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.scratch import materialise
from strata.sources import published
from strata.sources.upsert import read_upserted


def refresh_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    keep: int = published.KEPT,
    hold_seconds: float = published.HOLD_SECONDS,
) -> int:
    """Replace the table at ``path`` by ``df``; the number of rows written.

    Readers (:func:`read_table`) have the old rows until the new ones are all there, then the
    new ones; a job that fails leaves the table as it was. ``df`` may read the table. Replaced
    rows are deleted once they are neither among the latest ``keep`` versions nor were replaced
    less than ``hold_seconds`` ago.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before, folder = published.latest(spark, path), published.new_folder(path)
    df.write.partitionBy(*partition_by).parquet(f"{path}/{folder}")
    # Counted where they lie: what a task observes may be observed again if its executor is lost.
    rows = published.rows_of(spark, path, [folder], df.schema).count()
    notes = {"schema": df.schema.jsonValue(), "rows": rows}
    published.publish(spark, path, {"rows": [folder]}, notes, before)
    published.expire(spark, path, keep, hold_seconds)
    return rows


def append_table(df: DataFrame, path: str, once: tuple[str, int] | None = None) -> int:
    """Add the rows of ``df`` to the table at ``path``; the number of rows added.

    ``once`` names a stream and the number of its micro-batch: one that has been added before is
    not added again. The columns of a table stay.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    version = published.latest(spark, path)
    schema = published.stored_schema(df.schema).jsonValue()
    if version.notes.get("schema", schema) != schema:
        raise ValueError(f"the table was made with {version.notes['schema']}")
    taken = dict(version.notes.get("taken", {}))
    if once is not None and taken.get(once[0], -1) >= once[1]:
        return 0
    folder = published.new_folder(path)
    df.write.parquet(f"{path}/{folder}")
    rows = published.rows_of(spark, path, [folder], df.schema).count()
    listed = [*version.folders.get("rows", []), *([folder] if rows else [])]
    if once is not None:
        taken[once[0]] = once[1]
    notes = {"schema": schema, "rows": version.notes.get("rows", 0) + rows, "taken": taken}
    published.publish(spark, path, {"rows": listed}, notes, version)
    published.expire(spark, path)
    return rows


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table as it is now: a published one, or a plain folder that streams append to."""
    version = published.latest(spark, path)
    if version is published.NONE:
        return spark.read.parquet(path)
    if "buckets" in version.notes:
        return read_upserted(spark, path)
    schema = T.StructType.fromJson(version.notes["schema"])
    return published.rows_of(spark, path, version.folders["rows"], schema)


def replace_catalog_table(df: DataFrame, name: str) -> int:
    """Create or replace the catalog table ``name`` with the rows of ``df``.

    The rows are written to a folder of their own before the catalog is touched, so a job that
    fails leaves the old table as it was. With the same columns the table is then pointed to the
    new folder in one step; with others a table that has been made beside it takes its name.
    ``df`` may read the table, whose old folder is left in the warehouse.
    """
    spark = df.sparkSession
    beside = f"{name}_{uuid.uuid4().hex}"
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    folder = f"{warehouse}/{beside.rpartition('.')[2]}.rows"
    df.write.parquet(folder)
    rows = spark.read.schema(df.schema).parquet(folder).count()
    if spark.catalog.tableExists(name) and _alike(spark.table(name).schema, df.schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    else:
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE {beside} ({listed}) USING parquet LOCATION '{folder}'")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {beside} RENAME TO {name.rpartition('.')[2]}")
    spark.catalog.refreshTable(name)
    return rows


def _alike(left: T.StructType, right: T.StructType) -> bool:
    return [(f.name, f.dataType) for f in left] == [(f.name, f.dataType) for f in right]


def create_if_absent(spark: SparkSession, name: str, columns: dict[str, str]) -> DataFrame:
    """A catalog table of these columns; left as it is where it exists."""
    listed = ", ".join(f"`{c}` {kind}" for c, kind in columns.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({listed}) USING parquet")
    return spark.table(name)


def empty_table(spark: SparkSession, name: str) -> None:
    """Remove all rows of a catalog table and keep its columns."""
    spark.sql(f"TRUNCATE TABLE {name}")


def reload_table(df: DataFrame, name: str) -> int:
    """Fill a catalog table anew, columns matched by name and cast as declared.

    The rows are computed and stored before the table is touched: an error leaves it as it was,
    and ``df`` may read it.
    """
    spark = df.sparkSession
    target = spark.table(name).schema
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])
    staged = materialise(rows, "reload")
    seen = Observation()
    counted = staged.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.insertInto(name, overwrite=True)
    return seen.get["rows"]
