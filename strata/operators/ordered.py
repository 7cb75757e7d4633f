"""Ordering over the whole cluster: range slices, dense numbers, neighbours of a row.

A window without partition keys moves all rows to one task, and a window over a key with a
third of all rows moves a third of them. Both become slices here: Spark's range partitioning
sorts the rows over all tasks, the sorted rows are written with the slice they are in, and what
crosses a slice border is added from a table with one row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.scratch import materialise

SLICE = "_slice"
PLACE = "_place"
_ROW_BITS = 33  # Fixed value: monotonically_increasing_id keeps the row number in 33 bits.


def range_slices(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` sorted by ``by`` over all tasks, written, with slice and place in the slice."""
    sorted_rows = df.orderBy(*by).withColumn(PLACE, F.monotonically_increasing_id())
    numbered = sorted_rows.withColumns(
        {
            SLICE: F.shiftright(PLACE, _ROW_BITS).cast("int"),
            PLACE: F.col(PLACE).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )
    return materialise(numbered, "slices")


def _slice_starts(stored: DataFrame, size: Column) -> DataFrame:
    """Per slice the total of ``size`` in all earlier ones; one row per task of the sort."""
    sizes = stored.groupBy(SLICE).agg(size.alias("_size"))
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    return sizes.select(SLICE, before.cast("bigint").alias("_before"))


def dense_numbers(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """``df`` with 1..n in the order of ``by`` in front, as BIGINT.

    ``by`` should be unique; ties are numbered in no particular order.
    """
    stored = range_slices(df, by)
    starts = _slice_starts(stored, F.count(F.lit(1)))
    number = F.col("_before") + F.col(PLACE) + 1
    return stored.join(F.broadcast(starts), SLICE).select(number.alias(name), *df.columns)


def group_starts(groups: DataFrame, key: str, size: str, name: str) -> DataFrame:
    """Per group the total ``size`` of all groups with a smaller ``key``; one row per group.

    Numbers the rows of groups in the order of their keys without sorting the rows: the
    number of a row is the start of its group plus its place in the group.
    """
    stored = range_slices(groups.select(key, size), [key])
    starts = _slice_starts(stored, F.sum(size))
    inside = Window.partitionBy(SLICE).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)
    within = stored.select(
        key, SLICE, F.coalesce(F.sum(size).over(inside), F.lit(0)).alias("_within")
    )
    start = F.col("_before") + F.col("_within")
    return within.join(F.broadcast(starts), SLICE).select(key, start.alias(name))


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    back: bool,
) -> DataFrame:
    """Adds ``value`` of the row before (``back``) or after in each key; NULL at the ends.

    With a slice column in ``df`` a key may span many slices: each slice works alone, and its
    first (or last) row takes the value from the nearest slice that has rows of the key.
    """
    shift = F.lag if back else F.lead
    if SLICE not in df.columns:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, shift(value).over(window))
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order)
    border_of = F.max_by if back else F.min_by
    borders = df.groupBy(*keys, SLICE).agg(
        border_of(F.struct(value.alias("v")), F.struct(*[F.col(o) for o in order])).alias("_b")
    )
    across = Window.partitionBy(*keys).orderBy(SLICE)
    borders = borders.select(*keys, SLICE, shift("_b").over(across).alias("_b"))
    shifted = df.withColumn("_in", shift(F.struct(value.alias("v"))).over(inside))
    return (
        shifted.join(borders, [*keys, SLICE], "left")
        .withColumn(name, F.coalesce("_in", "_b")["v"])
        .drop("_in", "_b")
    )


def carried_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
) -> DataFrame:
    """Adds the latest non-NULL ``value`` up to each row of a key, across slices if there are any."""
    if SLICE not in df.columns:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        return df.withColumn(name, F.last(value, ignorenulls=True).over(window))
    inside = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    place = F.struct(*[F.col(o) for o in order])
    ends = df.groupBy(*keys, SLICE).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), place)).alias("_end")
    )
    before = (
        Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    ends = ends.select(*keys, SLICE, F.last("_end", ignorenulls=True).over(before).alias("_end"))
    filled = df.withColumn("_in", F.last(value, ignorenulls=True).over(inside))
    return (
        filled.join(ends, [*keys, SLICE], "left")
        .withColumn(name, F.coalesce("_in", "_end"))
        .drop("_in", "_end")
    )
