"""Which deliveries a stage has taken, so that a second run changes nothing.

The ledger of a lake is an append-only table of small facts: a batch was started, a batch is done with so many rows, a file with this
digest has landed. A stage looks a delivery up before it works, replaces what an unfinished run of the same delivery left, and
notes it as done when everything is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.layout import sized
from ..runtime import hadoop_path
from ..sources.tables import read_table, table_exists

FACTS = "dataset string, batch string, state string, file_name string, digest string, length long, item string, row_count long"
BATCH = "_batch_id"


def batch_id(spark: SparkSession, path: str) -> str:
    """A name for exactly the files that ``path`` (a file, folder or glob) holds now: their paths, sizes and times.

    Only the listing is read. The same files give the same name whatever their order; a file that was added, removed or
    written again gives another.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    mark = F.xxhash64("path", "length", "modificationTime")
    whole = files.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(mark), F.lit(0)).alias("x"),
        F.coalesce(F.sum(F.pmod(mark, F.lit(2_147_483_647))), F.lit(0)).alias("s"),
    ).first()
    return f"{whole.n}-{whole.x & (1 << 64) - 1:016x}-{whole.s:x}"


def facts(spark: SparkSession, path: str) -> DataFrame:
    """All that was noted so far; no rows where there is no ledger yet."""
    if not table_exists(spark, path):
        return spark.createDataFrame([], FACTS)
    return spark.read.schema(FACTS).parquet(path)


def note(spark: SparkSession, path: str, dataset: str, batch: str, state: str, counts: dict[str, int] | None = None) -> None:
    """Append that a batch has come to a state, with the rows of each item."""
    items = list((counts or {}).items()) or [(None, None)]
    rows = [(dataset, batch, state, None, None, None, item, n) for item, n in items]
    spark.createDataFrame(rows, FACTS).coalesce(1).write.mode("append").parquet(path)


def done_counts(spark: SparkSession, path: str, dataset: str, batch: str) -> dict[str, int] | None:
    """The rows of each item of a batch that is done, None when it is not."""
    found = facts(spark, path).where((F.col("dataset") == dataset) & (F.col("batch") == batch) & (F.col("state") == "done"))
    rows = found.groupBy("item").agg(F.max("row_count").alias("n")).collect()
    return {r["item"]: r.n for r in rows} if rows else None


def replace_batch(df: DataFrame, path: str, batch: str) -> int:
    """Write the rows of one batch in the place of what an earlier run of that batch wrote; returns how many there are.

    The table is partitioned by ``_batch_id`` and only that partition is overwritten. A batch without rows leaves none behind.
    """
    seen = Observation()
    rows = sized(df).observe(seen, F.count(F.lit(1)).alias("rows")).withColumn(BATCH, F.lit(batch))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)
    count = seen.get["rows"]
    if not count:
        fs, folder = hadoop_path(df.sparkSession, f"{path}/{BATCH}={batch}")
        fs.delete(folder, True)
    return count


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches' rows, the batch's name as text."""
    return read_table(spark, path, mergeSchema=True).withColumn(BATCH, F.col(BATCH).cast("string"))
