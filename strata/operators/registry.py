"""Surrogate keys that stay: a number once given to a business key is never another's.

Numbering afresh, as ``surrogate_key`` does, changes the number of nearly every row when one
comes in between, and with it every stored fact. Here a registry (a published table of business
keys and numbers) is asked first, and only keys that it does not have get new numbers, the next
after its largest.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.ordered import dense_numbers
from strata.scratch import materialise
from strata.sources import published

# Folders of a registry before they are merged; every build with new keys adds one.
FOLDERS = 50


def _same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Business keys and their numbers."""
    version = published.latest(spark, path)
    if version is published.NONE:
        raise ValueError(f"there is no registry at {path}")
    schema = T.StructType.fromJson(version.notes["schema"])
    return published.rows_of(spark, path, version.folders["rows"], schema)


def stable_keys(
    df: DataFrame, by: Sequence[str], name: str, registry: str, folders: int = FOLDERS
) -> DataFrame:
    """``df`` with the number of its business key ``by`` in front, as BIGINT.

    Keys seen before have the number they had. New ones are numbered in the order of ``by``,
    without gaps, from the largest number on; the first build numbers like ``surrogate_key``.
    NULL is a value of a business key. Rows with the same business key get the same number. A
    key that is gone keeps its number for the day it comes back.

    The new keys are published before any row is returned, so a build that fails later and runs
    again finds them. One writer per registry.
    """
    spark, by = df.sparkSession, list(by)
    stored = materialise(df, "registry-rows")
    version = published.latest(spark, registry)
    kinds = [T.StructField(n, published.stored_schema(stored.schema)[n].dataType) for n in by]
    schema = T.StructType([*kinds, T.StructField(name, T.LongType())])
    if version is not published.NONE and version.notes["schema"] != schema.jsonValue():
        raise ValueError(f"the registry was made for {version.notes['schema']}")
    known_names = [f"_known_{n}" for n in by]
    number = f"_known_{name}"

    def known(listed: Sequence[str]) -> DataFrame:
        rows = published.rows_of(spark, registry, listed, schema)
        return rows.toDF(*known_names, number)

    listed = version.folders.get("rows", [])
    keys = stored.select(*by).distinct()
    unseen = keys.join(known(listed), _same_keys(by, known_names), "left_anti")
    numbered = dense_numbers(unseen, by, name)
    last = version.notes.get("last", 0)
    fresh = numbered.select(*by, (F.col(name) + last).alias(name))
    folder = published.new_folder(registry)
    fresh.write.parquet(f"{registry}/{folder}")
    count = published.rows_of(spark, registry, [folder], schema).count()
    if count or version is published.NONE:
        listed = [*listed, folder]
        if len(listed) > folders:
            merged = published.new_folder(registry)
            published.rows_of(spark, registry, listed, schema).write.parquet(f"{registry}/{merged}")
            listed = [merged]
        notes = {"schema": schema.jsonValue(), "last": last + count}
        published.publish(spark, registry, {"rows": listed}, notes, version)
        published.expire(spark, registry)
    joined = stored.join(known(listed), _same_keys(by, known_names))
    return joined.select(F.col(number).alias(name), *[f"`{c}`" for c in df.columns])
