"""The pipeline against a plain version of each stage, and on tables without rows."""

from pathlib import Path

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import decontaminate, minhash, toxicity

from .test_operators import PASSAGE, plain_components, toxic_rows

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def folder_of(spark, path: Path, docs, labels, items) -> str:
    spark.createDataFrame(docs, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_take_effect(spark, tmp_path):
    rows = toxic_rows(600, 3)
    extra = [(1, f"{rows[0][1]} {PASSAGE}"), (3, None), (5, ""), (None, "a row without an id")]
    extra += [(rows[8][0] + 1, rows[8][1]), (rows[8][0], rows[8][1])]
    docs = [(i, t, "en", "s", 1) for i, t, _ in rows] + [(i, t, None, None, None) for i, t in extra]
    sf_dir = folder_of(spark, tmp_path, docs, [(i, 0, y) for i, _, y in rows], [(1, PASSAGE), (2, None)])
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, sf_dir)
        assert table.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen.append(sorted(((r.doc_id, r.text) for r in table.collect()), key=str))
    toxic = {i for i, _, y in rows if y}
    calm, single, clean = seen
    assert len({i for i, _ in calm} & toxic) <= 3 and len({i for i, _ in calm} - toxic) >= 480
    ids = [i for i, _ in calm if i is not None]
    _, names = plain_components([t for i, t in calm if i is not None], ids, 5, 80)
    assert sorted(i for i, _ in single if i is not None) == sorted({i for i, n in zip(ids, names, strict=True) if i == n})
    assert (None, "a row without an id") in single
    assert [x for x in single if x not in clean] == [(1, extra[0][1])]
    packed = corpus_pipeline.run(spark, sf_dir)
    assert packed.where("doc_id IS NOT NULL").select("doc_id").distinct().count() == pytest.approx(len(clean) - 1, abs=3)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


@pytest.mark.parametrize("kind", ["long", "int", "string"])
def test_rows_without_an_id_are_judged(spark, tmp_path, kind):
    texts = {n: " ".join(f"{n}{i}" for i in range(60)) for n in ("clean", "other", "third", "copied", "lone")}
    docs = [
        (None, texts["clean"]), (None, f"{texts['other']} {PASSAGE}"), (None, texts["copied"]), (None, texts["copied"]), (9, texts["copied"]),
        (7, texts["copied"]), (None, texts["lone"]), (None, texts["lone"]), (3, texts["third"]), (3, texts["other"]), (3, None), (4, f"{PASSAGE} x"),
        (5, ""), (5, None), (None, ""), (None, None),
    ]
    sf_dir = folder_of(spark, tmp_path, [], [], [(1, PASSAGE)])
    table = spark.createDataFrame([(i, t, "k") for i, t in docs], "doc_id long, text string, ROW_KEY string").withColumn("doc_id", F.col("doc_id").cast(kind))
    single = corpus_pipeline.drop_near_duplicates(spark, table, sf_dir)
    clean = corpus_pipeline.drop_contaminated(spark, single, sf_dir)
    assert single.schema == clean.schema == table.schema
    rows = [(None if r.doc_id is None else int(r.doc_id), r.text or "") for r in clean.collect()]
    left = [(None, texts["clean"]), (7, texts["copied"]), (None, texts["lone"]), (3, texts["third"]), (3, texts["other"]), (5, ""), (None, ""), (None, "")]
    assert sorted(rows, key=str) == sorted(left, key=str)
    assert {r.text for r in single.collect()} - {r.text for r in clean.collect()} - {None} == {docs[1][1], docs[11][1]}


def test_no_rows(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder_of(spark, tmp_path, [], [], [])).count() == 0


def test_stages_call_the_operators():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "packing"]
    assert all((toxicity.train, minhash.near_duplicates, decontaminate.contaminated))
