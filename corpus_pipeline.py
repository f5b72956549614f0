"""From raw documents to packed training sequences: four stages, each written as Parquet before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import decontaminate, minhash, packing, toxicity
from lakestrata.llm.store import keyed, ready, rows_without, saved


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; documents without an id are scored and judged as well."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(toxicity.training_rows(docs, labels))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (sets of five-word shingles, similarity 0.8) the row with the smallest id stays.

    Rows are compared by their texts, with a key of their own in place of the id: those without an id take part (one of
    them stays if no row of the group has an id), and different texts of one id are different documents. Texts
    without words are copies of nothing; of such rows with one id only one stays, and none beside a row with words.
    """
    rows, key = keyed(docs, "rows")
    found = saved(minhash.near_duplicates(rows, id_col=key), "near").select(F.col("doc_id").alias("found_key"), "component_id", "n_shingles")
    ids = rows.select(key, F.col("doc_id").alias("own_id"))
    marks = saved(found.join(ids, F.col("found_key") == F.col(key)).drop(key), "marks")
    rank = F.struct(F.col("own_id").isNull(), "own_id", "found_key")
    first = marks.groupBy("component_id").agg(F.min(rank).alias("first")).select(F.col("first.found_key").alias("kept_key"))
    gone = marks.join(first, F.col("found_key") == F.col("kept_key"), "left_anti").select("found_key")
    best = F.min(F.struct(F.col("n_shingles") == 0, "found_key")).alias("best")
    full = marks.where("own_id IS NOT NULL").groupBy("own_id").agg(best, F.count(F.lit(1)).alias("n")).where("n > 1")
    kept_empty = full.where("best.col1").select(F.col("best.found_key").alias("kept_key"))
    empty = marks.where("n_shingles = 0 AND own_id IS NOT NULL").join(full.select(F.col("own_id").alias("full_id")), F.col("own_id") == F.col("full_id"), "left_semi")
    empty = empty.join(kept_empty, F.col("found_key") == F.col("kept_key"), "left_anti").select("found_key")
    return rows_without(rows, key, saved(gone.unionByName(empty), "gone")).drop(key)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a passage of the benchmark go, whatever their id: each is judged by a key of its own."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, key = keyed(docs, "rows")
    gone = saved(decontaminate.contaminated(rows, benchmark, id_col=key).select("doc_id").distinct(), "contaminated")
    return rows_without(rows, key, gone).drop(key)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, packed into sequences of 4096."""
    ready(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# tokenizer, trained model and min-max signatures have no SQL form; tests/llm compares run() with a plain version
ORACLE_SQL = None
