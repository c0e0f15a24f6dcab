"""Calendar attributes and timestamp parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerkit.functions._util import as_col


def day_name(col) -> Column:
    """English weekday name (Monday ... Sunday)."""
    return F.date_format(as_col(col), "EEEE")


def iso_week(col) -> Column:
    """ISO-8601 week number (2027-01-03 is week 53)."""
    return F.weekofyear(as_col(col))


def week_start(col) -> Column:
    """Monday of the ISO week, as DATE."""
    return F.date_trunc("week", as_col(col)).cast("date")


def is_weekend(col) -> Column:
    """Saturday or Sunday (Spark numbers Sunday 1 ... Saturday 7)."""
    return F.dayofweek(as_col(col)).isin(1, 7)


def parse_ts(col, strict: bool = False) -> Column:
    """ISO timestamp text to TIMESTAMP_NTZ; ``strict=False`` gives NULL on bad text."""
    c = as_col(col)
    return c.cast("timestamp_ntz") if strict else c.try_cast("timestamp_ntz")
