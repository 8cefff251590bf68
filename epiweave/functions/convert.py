"""Tolerant conversions: a value that does not parse becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(col: Column) -> Column:
    """Number or null; NaN counts as missing."""
    value = col.try_cast("double")
    return F.when(~F.isnan(value), value)


def to_int(col: Column) -> Column:
    """Whole part or null. Goes through double because '3.0' is not an int literal."""
    return col.try_cast("double").try_cast("int")


def bankers(col: Column, decimals: int = 0) -> Column:
    """Half-even rounding, as Python's ``round``."""
    return F.bround(col, decimals)


def week_label(year: Column, week: Column) -> Column:
    return F.format_string("%d-W%02d", year, week)
