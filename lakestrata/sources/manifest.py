"""What lies in a layer: file manifests, their comparison, table metrics."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..runtime import hadoop_path
from .footers import file_footers


def _name_below(spark: SparkSession, root: str, path: Column) -> Column:
    """File path relative to the folder the scan starts from (a glob starts at its last plain folder)."""
    folder = re.split(r"[*?\[{]", root, maxsplit=1)[0]
    if folder != root:
        folder = folder.rsplit("/", 1)[0]
    fs, jpath = hadoop_path(spark, folder)
    return F.substr(path, F.lit(len(fs.makeQualified(jpath).toString()) + 2))


def _digests(lines: DataFrame) -> DataFrame:
    """``path, method, digest`` of text files, built by as many tasks as Spark cuts them into.

    A line counts by its hash times its number in the file, so swapped lines show. Within a block lines are
    numbered by the task that reads it; the lines of the blocks before it are added afterwards, block by block:
    sum(h * (n + before)) = sum(h * n) + before * sum(h). All sums are kept modulo a 31-bit prime, once for each
    half of the hash, so nothing overflows.
    """
    prime = F.lit(2_147_483_647).cast("long")
    hashed, place = F.xxhash64("value"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    halves = {"a": F.pmod(hashed, prime), "b": F.pmod(F.shiftrightunsigned(hashed, 31), prime)}
    rows = lines.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), place.alias("n"),
        *[h.alias(k) for k, h in halves.items()],
    )
    sums = [F.sum(k).alias(f"sum_{k}") for k in halves] + [F.sum(F.col(k) * F.pmod("n", prime) % prime).alias(f"by_{k}") for k in halves]
    blocks = rows.groupBy("path", "block").agg(F.count(F.lit(1)).alias("lines"), F.min("n").alias("first"), *sums)
    before = F.coalesce(F.sum("lines").over(W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    moved = blocks.withColumn("shift", F.pmod(before - F.col("first"), prime))
    whole = [F.pmod(F.sum((F.col(f"by_{k}") + F.col("shift") * (F.col(f"sum_{k}") % prime)) % prime), prime).cast("string") for k in halves]
    return moved.groupBy("path").agg(F.concat_ws(":", F.sum("lines").cast("string"), *whole).alias("digest")).select(
        # a URI, other than the plain path of a listing; "+" is no blank in it
        F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("path"), F.lit("lines").alias("method"), "digest"
    )


def file_manifest(spark: SparkSession, path: str, glob: str = "*.csv", method: str = "lines") -> DataFrame:
    """``file_name, length, method, digest`` of the files below ``path``, named relative to it.

    Files of any size are treated alike. ``lines`` (text files) reads them in parts by many tasks: number
    of lines and a digest of each line at its place; only ``\\n`` ends a line, so other changed bytes show, and
    the length tells whether the last line is ended. Spark's scans
    leave out files without any byte. ``md5`` is the usual digest; one task takes a file as a
    whole, so it is meant for files well below a task's memory.
    """
    if method not in ("lines", "md5"):
        raise ValueError(f"unknown method {method!r}; use lines or md5")
    options = {"pathGlobFilter": glob, "recursiveFileLookup": True}
    listed = spark.read.format("binaryFile").options(**options).load(path)
    name = _name_below(spark, path, F.col("path")).alias("file_name")
    if method == "md5":
        return listed.select(name, "length", F.lit("md5").alias("method"), F.md5("content").alias("digest"))
    found = _digests(spark.read.options(**options).option("lineSep", "\n").text(path))
    return listed.select("path", "length").join(found.select(F.col("path").alias("read_path"), "digest"), F.col("path") == F.col("read_path"), "left").select(
        name, "length", F.lit("lines").alias("method"), F.coalesce("digest", F.lit("0:0:0")).alias("digest")
    )


def compare_manifests(before: DataFrame, after: DataFrame, key: str = "file_name") -> DataFrame:
    """``key, status``: ok, changed, missing (gone after) or unexpected (new after)."""
    left = before.select(key, F.struct("length", "method", "digest").alias("was"))
    right = after.select(key, F.struct("length", "method", "digest").alias("now"))
    status = (
        F.when(F.col("now").isNull(), "missing")
        .when(F.col("was").isNull(), "unexpected")
        .when(F.col("was") == F.col("now"), "ok")
        .otherwise("changed")
    )
    return left.join(right, key, "full_outer").select(key, status.alias("status"))


def table_metrics(spark: SparkSession, tables: Mapping[tuple[str, str], str], fmt: str = "parquet") -> DataFrame:
    """``layer, table, files, bytes, rows`` of each ``(layer, name): path``.

    Parquet tables are told by their files' footers, one row a file (``sources.footers``). Of other formats no column
    is read: the scan gives empty rows, which are counted per file and then added up.
    """
    result = None
    for (layer, name), path in tables.items():
        if fmt == "parquet":
            per_file = file_footers(spark, path).select(F.col("length").alias("file_size"), "rows")
        else:
            rows = spark.read.format(fmt).load(path)
            per_file = rows.groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("rows"))
        one = per_file.agg(
            F.lit(layer).alias("layer"),
            F.lit(name).alias("table"),
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("file_size"), F.lit(0)).cast("long").alias("bytes"),
            F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"),
        )
        result = one if result is None else result.unionByName(one)
    return result


def file_counts(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Number and bytes of the files below ``path`` by folder; contents are not opened."""
    return (
        spark.read.format("binaryFile")
        .options(pathGlobFilter=glob, recursiveFileLookup=True)
        .load(path)
        .select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"), "length")
        .groupBy("folder")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )
