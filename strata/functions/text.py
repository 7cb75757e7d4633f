"""Cleaning of text and numbers that arrive as strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squeezed(name: str) -> Column:
    """Text without outer blanks."""
    return F.trim(F.col(name))


def lowered(name: str) -> Column:
    return F.lower(squeezed(name))


def uppered(name: str) -> Column:
    return F.upper(squeezed(name))


def titled(name: str) -> Column:
    """Each word with a capital first letter and the rest in small letters."""
    return F.initcap(squeezed(name))


def parsed(name: str, type_name: str) -> Column:
    """Text read as ``type_name``; NULL where it cannot be read, never an error.

    Casting in ANSI mode stops the whole job on the first bad row. A NULL can be counted,
    dropped or set aside by an expectation instead.
    """
    return squeezed(name).try_cast(type_name)
