"""Relational tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    **options: object,
) -> DataFrame:
    """Table scan; with a partition column and its bounds, ``partitions`` tasks read in parallel.
    The bounds only place the split points, rows outside them are read too."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partitioned JDBC scan needs bounds for its partition column")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=partitions,
        )
    return reader.load()
