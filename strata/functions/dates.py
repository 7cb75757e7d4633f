"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: str | Column) -> Column:
    """A date as the integer yyyymmdd.

    Arithmetic on the parts rather than formatting and re-parsing a string.
    """
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def is_weekend(day: str | Column) -> Column:
    return F.weekday(day) >= 5


def day_before(day: str | Column) -> Column:
    return F.date_add(day, -1)
