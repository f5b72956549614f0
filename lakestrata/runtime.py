"""Session helpers: shared scratch folder, Hadoop file system, shuffle sizing."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

MB = 1024 * 1024


def hadoop_path(spark: SparkSession, path: str):
    """The JVM ``(FileSystem, Path)`` pair of any Hadoop URI."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session without it is an error, because rows in a machine-local folder would be lost on a cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table; the application's scratch goes away when it ends."""
    root = f"{shared_folder(spark)}/lakestrata/{spark.sparkContext.applicationId}"
    fs, jroot = hadoop_path(spark, root)
    if not fs.exists(jroot):
        fs.mkdirs(jroot)
        fs.deleteOnExit(jroot)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def input_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """Bytes below the given files, folders or globs (listing only, no data is read)."""
    total = 0
    for path in paths:
        fs, jpath = hadoop_path(spark, path)
        for status in fs.globStatus(jpath) or []:
            total += fs.getContentSummary(status.getPath()).getLength()
    return total


def shuffle_settings(total_bytes: int) -> dict[str, int]:
    """Shuffle and scan sizes for an input of ``total_bytes`` compressed bytes.

    Post-shuffle partitions start at about 128 MB of input each and stop growing at 32768,
    where map x reduce bookkeeping costs more than a spill (100 TB: 3 GB each; AQE merges
    what turns out small). Scan splits grow from 128 MB to 1 GB so that 100 TB is read by
    about 100,000 tasks instead of 800,000.
    """
    return {
        "partitions": min(32768, max(1, math.ceil(total_bytes / (128 * MB)))),
        "split_bytes": min(1024 * MB, max(128 * MB, math.ceil(total_bytes / 100_000))),
    }


def size_shuffles(spark: SparkSession, paths: Iterable[str]) -> dict[str, int]:
    """Raise (never lower) the session's shuffle and scan sizes to suit the input paths."""
    wanted = shuffle_settings(input_bytes(spark, paths))
    if wanted["partitions"] > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", wanted["partitions"])
    if wanted["split_bytes"] > 128 * MB:
        spark.conf.set("spark.sql.files.maxPartitionBytes", wanted["split_bytes"])
        # output files of a rebalanced write follow the advisory size
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", 512 * MB)
    return wanted


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the stages rely on: timestamps are parsed and cut into days in UTC.

    A projection that parses twenty text columns generates methods beyond the 8000 bytes HotSpot
    compiles; with the limit set to that, Spark splits them instead of running them interpreted
    (half the time for the trip set).
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", 8000)
    return spark
