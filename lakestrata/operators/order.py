"""The place of every row in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import scratch_path

_ROW_BITS = 33


def numbered(df: DataFrame, *order: str | Column, name: str = "position") -> DataFrame:
    """Add the row's number, from 1, in the given order.

    Rows are range-partitioned and sorted once and written; then the rows of each partition are counted, and what lies
    before a partition is added to the number within it. No task sees all rows, as it would under a window without
    keys; the driver gets one count a partition. Rows that are equal in ``order`` get their numbers in any order, so
    name a total one. An existing column ``name`` is an error; an empty table gives no rows.
    """
    spark = df.sparkSession
    taken = {c.lower() for c in df.columns}
    if name.lower() in taken:
        raise ValueError(f"the rows have a column {name} already")
    place = "_place"
    while place in taken:
        place += "_"
    path = scratch_path(spark, "ordered")
    df.orderBy(*order).withColumn(place, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    part = F.shiftright(place, _ROW_BITS)
    counts = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, starts = 0, []
    for r in sorted(counts):
        starts.append((r.part, before))
        before += r.n
    offsets = spark.createDataFrame(starts, "_part long, _before long")
    within = F.col(place).bitwiseAND(F.lit((1 << _ROW_BITS) - 1).cast("long"))
    return rows.join(F.broadcast(offsets), part == F.col("_part")).select(
        *df.columns, (F.col("_before") + within + 1).alias(name)
    )
