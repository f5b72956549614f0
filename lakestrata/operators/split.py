"""Row hygiene: quarantine splits and measure filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import is_blank
from ..sources.raw import CORRUPT


def invalid_row(key: str, required: Sequence[str] = (), corrupt: str = CORRUPT) -> Column:
    """True for rows the parser could not read, rows with a NULL or blank key, and rows with a NULL
    in a ``required`` column. Never NULL, so a filter and its negation cover every row."""
    return reduce(or_, [F.col(corrupt).isNotNull(), is_blank(key), *[F.col(c).isNull() for c in required]])


def split_invalid(
    df: DataFrame, key: str, required: Sequence[str] = (), corrupt: str = CORRUPT
) -> tuple[DataFrame, DataFrame]:
    """``(valid, bad)``: valid rows without the corrupt-record column, bad rows with ``_quarantined_at``."""
    bad = invalid_row(key, required, corrupt)
    return (
        df.where(~bad).drop(corrupt),
        df.where(bad).withColumn("_quarantined_at", F.current_timestamp()),
    )


def require_key(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not NULL (blank keys pass)."""
    return df.where(F.col(key).isNotNull())


def in_range(at_least: Mapping[str, float], not_null: Sequence[str] = ()) -> Column:
    """Every measure reaches its lower bound and every ``not_null`` column is set; a NULL measure fails."""
    rules = [F.col(c) >= F.lit(low) for c, low in at_least.items()]
    rules += [F.col(c).isNotNull() for c in not_null]
    return F.coalesce(reduce(and_, rules), F.lit(False))


def keep_in_range(df: DataFrame, at_least: Mapping[str, float], not_null: Sequence[str] = ()) -> DataFrame:
    return df.where(in_range(at_least, not_null))


def rejects(df: DataFrame, at_least: Mapping[str, float], not_null: Sequence[str] = ()) -> DataFrame:
    """The rows :func:`keep_in_range` drops, with every reason in ``_reasons`` (array of text)."""
    reasons = []
    for c, low in at_least.items():
        reasons.append(F.when(F.col(c).isNull(), f"{c} missing").when(F.col(c) < low, f"{c} below {low:g}"))
    reasons += [F.when(F.col(c).isNull(), f"{c} missing") for c in not_null]
    return df.where(~in_range(at_least, not_null)).withColumn("_reasons", F.array_compact(F.array(*reasons)))


def rejects_by_reason(df: DataFrame, at_least: Mapping[str, float], not_null: Sequence[str] = ()) -> DataFrame:
    """``reason, row_count``; a row with two faults counts under both."""
    return (
        rejects(df, at_least, not_null)
        .select(F.explode("_reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
