"""Intermediate tables in the shared folder, so that a lost executor costs a re-read and not a recomputation."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import scratch_path

def ready(spark: SparkSession) -> None:
    """Session settings the operators rely on.

    Whole texts go to Python in batches of a thousand rows: ten times as many, the usual number, take hundreds of
    MB beside the heap. ``spark.checkpoint.dir`` is used as it is set; only a local session without it (tests) gets
    a folder of its own. The workers of a local session also learn where this package lies; on a cluster it
    is installed or shipped (``--py-files``) like any other.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        return
    if not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lakestrata-llm-"))
    root, known = str(Path(__file__).resolve().parents[2]), context.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back: the lineage ends here."""
    spark = df.sparkSession
    ready(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows, written with a long of their own in a further column, and the name of that column."""
    key, taken = "row_key", {c.lower() for c in df.columns}
    while key in taken:
        key += "_"
    return saved(df.select("*", F.monotonically_increasing_id().alias(key)), name), key


def sampled(hashed: Column, most: int, rows: int) -> Column:
    """Whether a row is in a sample of about ``most`` of so many rows, by a 64-bit hash of it; all rows if there are no more.

    All bits below the sign are compared, so the share never falls to none however many rows there are.
    """
    return hashed.bitwiseAND(F.lit((1 << 63) - 1)) <= F.lit((1 << 63) - 1 if rows <= most else (most << 63) // rows)


class HashFilter:
    """A bit table of fixed size that tells for a 64-bit hash whether it may be among those given (three bits each).

    It is built by partial aggregation and holds ``bits / 8`` bytes whatever is put in, so it may be broadcast. Very
    many hashes fill it: it then lets more through, and the exact join that must follow sees more rows.
    """

    SHIFTS = (0, 19, 38)
    _PAGE = 15

    def __init__(self, hashes: DataFrame, bits: int):
        column, self.mask = hashes.columns[0], bits - 1
        each = [F.shiftrightunsigned(column, n).bitwiseAND(F.lit(self.mask).cast("long")) for n in self.SHIFTS]
        pages = (
            hashes.select(F.explode(F.array(*each)).alias("bit"))
            .groupBy(F.shiftright("bit", self._PAGE).alias("page"))
            .agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit((1 << self._PAGE) - 1).cast("long"))).alias("table"))
        )
        table, size = bytearray(bits // 8), 1 << (self._PAGE - 3)
        for row in pages.collect():
            table[row.page * size : (row.page + 1) * size] = row.table
        self.shared = hashes.sparkSession.sparkContext.broadcast(bytes(table))

    def held(self, values: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be among those given."""
        bits, places = np.frombuffer(self.shared.value, np.uint8), None
        for shift in self.SHIFTS:
            at = ((values if places is None else values[places]) >> np.uint64(shift)) & np.uint64(self.mask)
            hit = np.flatnonzero(bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1)
            places = hit if places is None else places[hit]
        return places


def _maybe(ids: DataFrame, id_column: Column, bits: int = 1 << 26) -> Column:
    """Whether an id may be among ``ids`` (first column). NULL is not."""
    seen = HashFilter(ids.select(F.xxhash64(ids.columns[0]).alias("hash")), bits)

    @F.pandas_udf("boolean")
    def found(hashes: pd.Series) -> pd.Series:
        out = np.zeros(len(hashes), bool)
        out[seen.held(hashes.to_numpy().view(np.uint64))] = True
        return pd.Series(out)

    return found(F.xxhash64(id_column)) & id_column.isNotNull()


def parted(df: DataFrame, column: Column, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose column may be among ``ids`` (one column), and those that surely are not, NULL included."""
    maybe = _maybe(ids, column)
    return df.where(maybe), df.where(~maybe)


def _as_id(df: DataFrame, id_col: str, ids: DataFrame) -> Column:
    """The id column in the type of ``ids``; what cannot be read as such is NULL."""
    return df[id_col].try_cast(ids.schema[0].dataType)


def rows_with(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows whose id is among ``ids`` (one column). Only rows that pass the filter are shuffled."""
    wanted = ids.select(F.col(ids.columns[0]).alias("wanted_id")).distinct()
    own = _as_id(df, id_col, wanted)
    return df.where(_maybe(wanted, own)).join(wanted, own == wanted["wanted_id"], "left_semi")


def rows_without(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows whose id is not among ``ids`` (one column), those with NULL id included. Rows that the filter
    rules out are taken as they are; only the others are shuffled."""
    gone = ids.select(F.col(ids.columns[0]).alias("gone_id")).distinct()
    own = _as_id(df, id_col, gone)
    maybe = _maybe(gone, own)
    return df.where(~maybe).unionByName(df.where(maybe).join(gone, own == gone["gone_id"], "left_anti"))
