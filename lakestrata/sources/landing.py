"""Dated landing of deliveries: only files that are new or have changed are taken."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..runtime import scratch_path
from ..sinks.ledger import FACTS, facts
from .manifest import compare_manifests, file_manifest
from .tables import Lake

LEDGER = "_ledger/landed"


def _copied(source: str, target: str):
    """Each file is streamed to a name of its own attempt and then renamed, so a task that is run again does no harm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        def opened(folder: str):
            if folder.startswith("file:"):
                folder = "/" + folder.removeprefix("file:").lstrip("/")
            return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)

        (here, base), (there, goal) = opened(source), opened(target)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for name in batch.column(0).to_pylist():
                end = f"{goal}/{name}"
                folder, _, plain = end.rpartition("/")
                there.create_dir(folder, recursive=True)
                part = f"{folder}/_{plain}.{attempt}"
                with here.open_input_stream(f"{base}/{name}") as read, there.open_output_stream(part) as write:
                    while block := read.read(8 << 20):
                        write.write(block)
                there.move(part, end)
            yield batch

    return run


def land(spark: SparkSession, lake: Lake, dataset: str, source: str, day: dt.date, glob: str = "*.csv") -> DataFrame:
    """``file_name, status`` of a delivery folder: ``new`` and ``changed`` files are now in the dated landing folder.

    The delivery's manifest is compared with the ledger's last digest of each file, and only files that are not known, or
    known with another digest or length, are copied to ``raw/<dataset>/yyyy/MM/dd`` by as many tasks as Spark deals their names
    to. The copies are compared with what was to be copied before the ledger takes them, so a landing that stopped half
    way is made up for by the next run, and a second run of the same delivery copies nothing (``unchanged``).
    """
    ledger, target = lake.path("bronze", LEDGER), lake.landing_path(dataset, day)
    now = file_manifest(spark, source, glob)
    order = W.partitionBy("file_name").orderBy(F.col("row_count").desc())
    # a file's facts carry the ordinal of the day they were noted on
    known = (
        facts(spark, ledger).where((F.col("dataset") == dataset) & (F.col("state") == "landed"))
        .withColumn("place", F.row_number().over(order)).where("place = 1")
        .select("file_name", F.struct("length", "digest").alias("was"))
    )
    status = F.when(F.col("was").isNull(), "new").when(F.col("was") == F.struct("length", "digest"), "unchanged").otherwise("changed")
    path = scratch_path(spark, "delivery")
    now.join(known, "file_name", "left").select("file_name", "length", "method", "digest", status.alias("status")).write.parquet(path)
    judged = spark.read.parquet(path)
    wanted = judged.where("status <> 'unchanged'")
    names = wanted.select("file_name")
    if names.isEmpty():
        return judged.select("file_name", "status")
    names.repartition("file_name").mapInArrow(_copied(source, target), "file_name string").write.format("noop").mode("overwrite").save()
    there = file_manifest(spark, target, glob).join(names, "file_name", "left_semi")
    faults = compare_manifests(wanted.select("file_name", "length", "method", "digest"), there).where("status <> 'ok'").limit(3).collect()
    if faults:
        raise OSError(f"landing in {target} differs from the delivery: {[tuple(f) for f in faults]}")
    noted = wanted.select(
        F.lit(dataset).alias("dataset"), F.lit(f"{day:%Y-%m-%d}").alias("batch"), F.lit("landed").alias("state"), "file_name", "digest",
        "length", F.col("status").alias("item"), F.lit(_next(spark, ledger, dataset)).cast("long").alias("row_count"),
    )
    noted.select(*[c.split()[0] for c in FACTS.split(", ")]).write.mode("append").parquet(ledger)
    return judged.select("file_name", "status")


def _next(spark: SparkSession, ledger: str, dataset: str) -> int:
    """One more than the greatest number of a landing so far, so the last of two landings is known whatever their days."""
    last = facts(spark, ledger).where(F.col("dataset") == dataset).agg(F.max("row_count")).first()[0]
    return (last or 0) + 1
