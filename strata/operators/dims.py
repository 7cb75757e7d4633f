"""Dimensions that need no history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import date_key, is_weekend
from strata.operators.ordered import dense_numbers


def surrogate_key(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """1..n in the order of ``by``; numbered afresh on every build."""
    return dense_numbers(df, by, name)


def date_dimension(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last month that ``column`` touches.

    No dates, no rows. The bounds stay inside the plan.
    """
    span = df.agg(
        F.trunc(F.min(column), "month").alias("first"), F.last_day(F.max(column)).alias("last")
    )
    days = span.select(F.explode(F.sequence("first", "last")).alias("full_date"))
    return days.select(
        date_key("full_date").alias("date_key"),
        "full_date",
        *[
            getattr(F, part)("full_date").cast("int").alias(part)
            for part in ("year", "quarter", "month")
        ],
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.dayofweek("full_date").alias("day_of_week"),
        F.date_format("full_date", "EEEE").alias("day_name"),
        is_weekend("full_date").alias("is_weekend"),
    )
