"""Dates taken from timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import as_column


def year_of(c: Column | str, default: int | None = None) -> Column:
    """Year as int; ``default`` stands in for NULL so that partition values are never NULL."""
    year = F.year(as_column(c))
    return year if default is None else F.coalesce(year, F.lit(default))


def month_of(c: Column | str, default: int | None = None) -> Column:
    month = F.month(as_column(c))
    return month if default is None else F.coalesce(month, F.lit(default))


def day_of(c: Column | str) -> Column:
    return F.to_date(as_column(c))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar days from ``start`` to ``end``, whatever the time of day."""
    return F.date_diff(as_column(end), as_column(start))
