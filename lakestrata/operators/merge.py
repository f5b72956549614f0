"""Keyed upsert of DataFrames (the file-level part is in ``sinks.tables``)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], newer_than: str | None = None, evolve: bool = False
) -> DataFrame:
    """Target after an upsert: rows with a source key replaced, new keys added, all others kept.

    ``source`` must be unique per key. It may hold the target's columns only; with ``evolve`` columns that are new
    are added to the target, NULL in its other rows. Columns the source lacks are an error. With ``newer_than`` a match is
    replaced only when the source value of that column is not older than the target's (NULL is oldest): the
    target's keys and times are looked up for the source, and all rows that no source row replaces stay as they are,
    also those with a NULL or repeated key.
    """
    new = [c for c in source.columns if c not in target.columns]
    if new and not evolve:
        raise ValueError(f"the target has no columns {new}")
    if lacking := [c for c in target.columns if c not in source.columns]:
        raise ValueError(f"the source has no columns {lacking}")
    target = target.withColumns({c: F.lit(None).cast(source.schema[c].dataType) for c in new})
    source = source.select(*target.columns)
    if newer_than is not None:
        latest = (
            target.join(source.select(*keys), list(keys), "left_semi")
            .groupBy(*keys).agg(F.max(newer_than).alias("_latest"))
        )
        not_older = F.col("_latest").isNull() | (F.col(newer_than) >= F.col("_latest"))
        source = source.join(latest, list(keys), "left").where(not_older).select(*target.columns)
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source)


def key_faults(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``null_keys, repeated_keys`` about a merge source."""
    null_key = reduce(or_, [F.col(c).isNull() for c in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum(F.when(null_key, F.col("n"))), F.lit(0)).alias("null_keys"),
            F.coalesce(F.sum(F.when(~null_key & (F.col("n") > 1), 1)), F.lit(0)).alias("repeated_keys"),
        )
    )


def merge_into_table(source: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Upsert into a catalog table whose format has row-level operations of its own (Delta, Iceberg)."""
    match = reduce(and_, [F.col(f"{table}.{c}") == F.col(f"source.{c}") for c in keys])
    source.alias("source").mergeInto(table, match).whenMatched().updateAll().whenNotMatched().insertAll().merge()
