"""Batch identity and the business date a batch stands for."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The folder names that carry the batch, and the open end of a validity.
BATCH_PATTERN = r"/(batch_\d+)/[^/]+\.csv(?:/|$)"
OPEN_END = date(9999, 12, 31)


def batch_of_path(path: Column) -> Column:
    """``batch_N``, the folder right above the file or table; an empty string if it is none."""
    return F.regexp_extract(path, BATCH_PATTERN, 1)


def batch_number(batch_id: str | Column) -> Column:
    """The number in ``batch_N``, so that batch_10 comes after batch_2.

    Dates and times of day fit; a number beyond BIGINT stops the job, for without an order of
    the batches the latest row could not be told.
    """
    column = F.col(batch_id) if isinstance(batch_id, str) else batch_id
    digits = F.regexp_extract(column, r"(\d+)$", 1)
    number = digits.try_cast("bigint")
    too_long = F.raise_error(F.concat(F.lit("batch number too long: "), column)).cast("bigint")
    return F.when((digits != "") & number.isNull(), too_long).otherwise(number)


def effective_date(batch_id: str | Column, dates: dict[str, date]) -> Column:
    """The business date of a batch; a batch without a date stops the job.

    Guessing a date for an unknown batch would write wrong history.
    """
    column = F.col(batch_id) if isinstance(batch_id, str) else batch_id
    if not dates:
        raise ValueError("at least one batch needs a date")
    unknown = F.raise_error(
        F.concat(F.lit("no effective date for batch "), F.coalesce(column, F.lit("NULL")))
    ).cast("date")
    return reduce(
        lambda rest, item: F.when(column == item[0], F.lit(item[1])).otherwise(rest),
        dates.items(),
        unknown,
    )
