"""How rows are spread over files."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sized(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Spread rows so that a partitioned write makes few, well filled files.

    AQE merges small pieces up to the advisory size and splits a partition value that holds most of
    the table, so one hot month is written by many tasks.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def _limits(df: DataFrame, name: str, parts: int) -> list:
    """At most ``parts - 1`` values of a column that cut it into parts of about equal size, in its own type.

    The column alone is range-partitioned and the least value of each part comes back.
    """
    values = df.select(name).where(F.col(name).isNotNull()).repartitionByRange(parts, name)
    least = values.groupBy(F.spark_partition_id().alias("part")).agg(F.min(name).alias("least")).orderBy("least").collect()
    return list(dict.fromkeys(r.least for r in least))[1:]


def _spread(bucket: int, place: int, columns: int) -> int:
    """The bits of a bucket number moved apart, so that those of the other columns fit between them."""
    return sum(((bucket >> bit) & 1) << (bit * columns + place) for bit in range(bucket.bit_length()))


def _bucket(x: Column, cuts: Sequence, leaf: Callable[[int], int], base: int = 0) -> Column:
    """``leaf(number of cuts not above x)`` as a balanced tree of comparisons."""
    if not cuts:
        return F.lit(leaf(base)).cast("long")
    middle = len(cuts) // 2
    return F.when(x < F.lit(cuts[middle]), _bucket(x, cuts[:middle], leaf, base)).otherwise(
        _bucket(x, cuts[middle + 1 :], leaf, base + middle + 1)
    )


def with_z_key(df: DataFrame, columns: Sequence[str], name: str = "_cluster", bits: int = 6) -> DataFrame:
    """Add the Z-order key: the interleaved bits of each column's range bucket.

    Bucket limits are values of the column (at most ``2**bits - 1`` per column come back), compared in its own
    type, so text of a common prefix and skewed values still fill all buckets. NULL goes to bucket 0.
    """
    keys = {}
    for i, c in enumerate(columns):
        tree = _bucket(F.col(c), _limits(df, c, 2**bits), lambda b, i=i: _spread(b, i, len(columns)))
        keys[f"_key{i}"] = F.when(F.col(c).isNull(), F.lit(0).cast("long")).otherwise(tree)
    key = reduce(lambda a, b: a.bitwiseOR(b), [F.col(k) for k in keys])
    return df.withColumns(keys).withColumn(name, key).drop(*keys)


def clustered(
    df: DataFrame, columns: Sequence[str], partition_by: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """Rows ordered so that a file holds a small range of every cluster column.

    One column is sorted by itself, several by their Z-order key. A hash of the row ends the range
    key, so rows with one hot value are still cut into several files.
    """
    keyed = df.withColumn("_cluster", F.col(columns[0])) if len(columns) == 1 else with_z_key(df, columns)
    order = [F.col(c) for c in partition_by]
    sortable = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    spread = [*order, F.col("_cluster"), F.xxhash64(*sortable)]
    ranged = keyed.repartitionByRange(partitions, *spread) if partitions else keyed.repartitionByRange(*spread)
    return ranged.sortWithinPartitions(*order, "_cluster", *columns).drop("_cluster")


def clustering_depth(df: DataFrame, columns: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """``column, files, mean_depth, max_depth``: how many files of a table a value of each column meets.

    ``df`` is a plain read of the table. Each file's least and greatest value come from one aggregation per file; a sweep
    over their ends then counts the files that are open where a file begins, file limits included. A depth of 1 means
    that no ranges overlap. Values of different partitions never meet. A file with NULLs only takes no part. The sweep sees two
    rows per file and column, and a partition's files are swept by one task.
    """
    limits = [f(F.col(c)).alias(f"{e}{i}") for i, c in enumerate(columns) for f, e in ((F.min, "a"), (F.max, "b"))]
    files = df.groupBy(*partition_by, F.col("_metadata.file_path").alias("file")).agg(*limits)
    result = None
    for i, c in enumerate(columns):
        ends = F.array(
            F.struct(F.col(f"a{i}").alias("at"), F.lit(0).alias("closes")), F.struct(F.col(f"b{i}").alias("at"), F.lit(1).alias("closes"))
        )
        points = files.where(F.col(f"a{i}").isNotNull()).select(*partition_by, F.inline(ends))
        # at one value files are opened before others are closed, and all that open there count
        order = W.partitionBy(F.lit(i), *partition_by).orderBy("at", "closes").rangeBetween(W.unboundedPreceding, W.currentRow)
        open_files = F.sum(F.lit(1) - 2 * F.col("closes")).over(order)
        one = points.withColumn("depth", open_files).where("closes = 0").agg(
            F.lit(c).alias("column"),
            F.count(F.lit(1)).alias("files"),
            F.avg("depth").alias("mean_depth"),
            F.max("depth").alias("max_depth"),
        )
        result = one if result is None else result.unionByName(one)
    return result
