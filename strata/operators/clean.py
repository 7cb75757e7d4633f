"""Typed, standardised, one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def standardize(df: DataFrame, rules: Mapping[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    """One projection: every rule as a column of its name, then the columns of ``keep``."""
    return df.select(*[rule.alias(name) for name, rule in rules.items()], *keep)


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in which no key column is NULL; the scan can skip the others."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def latest_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The last row per key in the ascending order ``order``.

    Standardise first: keys that differ only in blanks are one key. ``order`` should be total.
    Spark keeps only the best row of each key in every map task before the shuffle, so copies
    of one key never meet in one task.
    """
    best_first = [F.desc(o) if isinstance(o, str) else o.desc() for o in order]
    window = Window.partitionBy(*keys).orderBy(*best_first)
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
    )


def latest_wins_aggregated(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The same rows as :func:`latest_wins`, found by aggregation."""
    place = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), place).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
