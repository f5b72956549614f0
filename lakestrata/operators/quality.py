"""Data-quality checks. Each returns rows ``check, table, column, violations, passed``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import is_blank
from .split import invalid_row


def _rows(df: DataFrame, check: str, table: str, violations: Mapping[str, Column]) -> DataFrame:
    """Turn a one-row frame into one check row per column."""
    entries = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(table).alias("table"),
            F.lit(name).alias("column"),
            F.coalesce(count.cast("long"), F.lit(0).cast("long")).alias("violations"),
        )
        for name, count in violations.items()
    ]
    return df.select(F.inline(F.array(*entries))).withColumn("passed", F.col("violations") == 0)


def _counted(df: DataFrame, check: str, table: str, faults: Mapping[str, Column]) -> DataFrame:
    """One pass over ``df`` that counts every fault."""
    names = {f"_v{i}": name for i, name in enumerate(faults)}
    one = df.agg(*[F.sum(F.when(faults[name], 1)).alias(v) for v, name in names.items()])
    return _rows(one, check, table, {name: F.col(v) for v, name in names.items()})


def schema_check(df: DataFrame, table: str, contract: Mapping[str, str]) -> DataFrame:
    """Every contract column is there with exactly its type; 1 violation where it is not."""
    actual = dict(df.dtypes)
    faults = {name: F.lit(int(actual.get(name) != kind)) for name, kind in contract.items()}
    return _rows(df.sparkSession.range(1), "schema", table, faults)


def null_check(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULL or blank values per required column."""
    return _counted(df, "not_null", table, {c: is_blank(c) for c in columns})


def range_check(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break a rule, given as ``{label: condition that must hold}``; NULL conditions pass."""
    return _counted(df, "range", table, {label: ~rule for label, rule in rules.items()})


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def unique_check(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows too many: all rows minus distinct keys."""
    spare = repeated_keys(df, keys).agg(F.sum(F.col("row_count") - 1).alias("spare"))
    return _rows(spare, "unique", table, {", ".join(keys): F.col("spare")})


def not_empty_check(df: DataFrame, table: str) -> DataFrame:
    one = df.agg(F.count(F.lit(1)).alias("n"))
    return _rows(one, "not_empty", table, {"*": F.when(F.col("n") == 0, 1).otherwise(0)})


def reconcile(detail: DataFrame, mart: DataFrame, measure: str, day: str) -> DataFrame:
    """``detail_rows, mart_total, difference, rows_without_day, passed``.

    The mart's measure must add up to the detail rows. Detail rows whose ``day`` column is NULL never
    reach a daily mart, so they are shown beside the difference. Both sides are one-row aggregates.
    """
    zero = F.lit(0).cast("long")
    left = detail.agg(
        F.count(F.lit(1)).alias("detail_rows"),
        F.count(F.when(F.col(day).isNull(), 1)).alias("rows_without_day"),
        zero.alias("mart_total"),
    )
    right = mart.agg(
        zero.alias("detail_rows"), zero.alias("rows_without_day"), F.sum(measure).cast("long").alias("mart_total")
    )
    return (
        left.unionByName(right)
        .agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("detail_rows", "mart_total", "rows_without_day")])
        .select(
            "detail_rows",
            "mart_total",
            (F.col("detail_rows") - F.col("mart_total")).alias("difference"),
            "rows_without_day",
            (F.col("detail_rows") == F.col("mart_total")).alias("passed"),
        )
    )


def row_balance(raw: DataFrame, kept: DataFrame, key: str, required: Sequence[str] = ()) -> DataFrame:
    """``raw_rows, bad_rows, duplicate_rows, kept_rows, passed``: nothing is lost between the raw scan
    and the cleaned table. Duplicates are counted from the keys, not taken as the rest."""
    bad = invalid_row(key, required)
    zero = F.lit(0).cast("long")
    per_key = raw.groupBy(bad.alias("_bad"), F.when(~bad, F.trim(key)).alias("_key")).agg(
        F.count(F.lit(1)).alias("n")
    )
    counts = per_key.agg(
        F.sum("n").alias("raw_rows"),
        F.sum(F.when(F.col("_bad"), F.col("n"))).alias("bad_rows"),
        F.sum(F.when(~F.col("_bad"), F.col("n") - 1)).alias("duplicate_rows"),
        zero.alias("kept_rows"),
    )
    kept_count = kept.agg(
        *[zero.alias(c) for c in ("raw_rows", "bad_rows", "duplicate_rows")], F.count(F.lit(1)).alias("kept_rows")
    )
    columns = ("raw_rows", "bad_rows", "duplicate_rows", "kept_rows")
    balance = counts.unionByName(kept_count).agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in columns])
    rest = F.col("raw_rows") - F.col("bad_rows") - F.col("duplicate_rows")
    return balance.select(*columns, (rest == F.col("kept_rows")).alias("passed"))


def unequal_rows(before: DataFrame, after: DataFrame, keys: Sequence[str], buckets: int = 4096, side: str = "side") -> DataFrame:
    """The rows that only one of two tables has, as often as it has them more, with ``side``: ``lost`` or ``added``.

    A changed row is lost in its old form and added in its new one; equal tables give no rows. Rows are put in buckets
    by a hash of their keys, and each bucket gets a fingerprint that does not depend on the order of rows: their number,
    the sum of one hash and the exclusive or of another. Only the rows of buckets whose fingerprints differ are
    shuffled and compared. Both tables need the same columns (by name); NULLs are equal to NULLs, and text and numbers
    are compared as they are. Two different buckets look alike with a chance of about 2**-90.
    """
    if sorted(before.columns) != sorted(after.columns):
        raise ValueError(f"columns differ: {sorted(set(before.columns) ^ set(after.columns))}")
    columns = before.columns
    if side.lower() in {c.lower() for c in columns}:
        raise ValueError(f"the rows have a column {side} already")
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    prime = F.lit(2_147_483_647).cast("long")

    def prints(df: DataFrame, name: str) -> DataFrame:
        hashed = F.xxhash64(*columns)
        return df.groupBy(bucket.alias("bucket")).agg(
            F.struct(
                F.count(F.lit(1)).alias("rows"),
                F.sum(F.pmod(hashed, prime)).alias("sum"),
                F.bit_xor(F.xxhash64(hashed, F.hash(*columns))).alias("xor"),
            ).alias(name)
        )

    differing = (
        prints(before, "was").join(prints(after.select(columns), "now"), "bucket", "full_outer")
        .where(~F.col("was").eqNullSafe(F.col("now"))).select(F.col("bucket").alias("_bucket"))
    )
    left, right = [df.select(columns).join(differing, bucket == F.col("_bucket"), "left_semi") for df in (before, after)]
    lost = left.exceptAll(right).withColumn(side, F.lit("lost"))
    return lost.unionByName(right.exceptAll(left).withColumn(side, F.lit("added")))
