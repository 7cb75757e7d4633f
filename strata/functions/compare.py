"""Comparison and fingerprints in which NULL is a value like any other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True where two lists of columns agree, NULL equal to NULL; never NULL itself."""
    return F.struct(*left).eqNullSafe(F.struct(*right))


def row_fingerprint(columns: Sequence[str]) -> Column:
    """md5 over the values of ``columns``, as 16 bytes.

    Every value is written with its length in front and NULL as a mark of its own, so
    different rows never write the same text: neither (a, NULL, b) and (a, b, NULL) nor
    values that contain the separator.
    """
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(
            F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))
        )
    return F.unhex(F.md5(F.concat_ws("|", *parts)))
