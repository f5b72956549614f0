"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "_row_rank"


def _sortable(field: T.StructField) -> bool:
    return not isinstance(field.dataType, (T.MapType, T.VariantType))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), total_order: bool = True) -> DataFrame:
    """The first row of each key by ``order``.

    ``total_order`` breaks the ties left by all other columns, largest value first, so the same input
    always keeps the same row, also when a task is run again. ``rank = 1`` lets Spark drop all but one
    row per key and task before the shuffle (WindowGroupLimit), so a key that holds a third of the
    table sends one row per task over the network.
    """
    ties = [F.col(f.name).desc_nulls_last() for f in df.schema if f.name not in keys and _sortable(f)]
    by = list(order) + (ties if total_order else [])
    if not by:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def latest_by(df: DataFrame, keys: Sequence[str], *columns: str) -> DataFrame:
    """Latest row per key by ``columns``, each descending with NULL last."""
    return keep_first(df, keys, [F.col(c).desc_nulls_last() for c in columns])


def distinct_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key combination, the same one on every run; NULL keys count as equal."""
    return keep_first(df, keys)
