"""Small presentation helpers for report rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .casts import as_column


def code_label(c: Column | str, labels: Mapping[object, str], default: str) -> Column:
    """Text for a code; every other value, also NULL, gets ``default``."""
    c = as_column(c)
    out = F
    for code, label in labels.items():
        out = out.when(c == F.lit(code), label)
    return out.otherwise(default)


def first_nonzero(*columns: Column | str) -> Column:
    """First column that is neither NULL nor 0, else 0."""
    return F.coalesce(*[F.nullif(as_column(c), F.lit(0)) for c in columns], F.lit(0))


def iso_json(df: DataFrame) -> Column:
    """The whole row as JSON text with ISO dates and timestamps."""
    fields = [
        F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
        else F.col(f.name)
        for f in df.schema
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
