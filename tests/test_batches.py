"""Deliveries taken once, dated landings, documents with faults, rows in a global order."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.order import numbered
from lakestrata.plans import orders, stages
from lakestrata.sinks import ledger
from lakestrata.sources.landing import land
from lakestrata.sources.raw import split_json_documents
from lakestrata.sources.tables import Lake, read_table


def order(key, status="DELIVERED", bought="2031-02-03 10:00:00"):
    return f"{key},CUST-{key},{status},{bought},,,,"


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(orders.RAW_COLUMNS), *lines]) + "\n")
    return str(path)


# --- batches ----------------------------------------------------------------------------------


def quarantined(spark, lake):
    return sorted(r._corrupt_record or r.order_id for r in read_table(spark, lake.path("silver", "quarantine/corrupted_orders")).collect())


def test_a_second_run_of_a_delivery_changes_nothing(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    first = write(tmp_path / "in" / "a.csv", [order("A"), "cut,off", order("B")])
    second = write(tmp_path / "in" / "b.csv", [order("A", "canceled"), "also,cut"])
    assert stages.bronze_to_silver(spark, lake, source_path=first) == {"quarantined": 1, "silver": 2}
    assert stages.bronze_to_silver(spark, lake, source_path=first) == {"quarantined": 1, "silver": 2}
    assert quarantined(spark, lake) == ["cut,off"]
    stages.bronze_to_silver(spark, lake, source_path=second)
    # the first delivery again: it is known, so the newer status stays
    stages.bronze_to_silver(spark, lake, source_path=first)
    assert quarantined(spark, lake) == ["also,cut", "cut,off"]
    status = {r.order_id: r.order_status for r in read_table(spark, lake.path("silver", "orders")).collect()}
    assert status == {"A": "canceled", "B": "delivered"}
    # unless it is asked for
    stages.bronze_to_silver(spark, lake, source_path=first, again=True)
    assert {r.order_id: r.order_status for r in read_table(spark, lake.path("silver", "orders")).collect()}["A"] == "delivered"
    assert quarantined(spark, lake) == ["also,cut", "cut,off"]


def test_a_run_that_stopped_half_way_is_made_up_for(spark, tmp_path, monkeypatch):
    lake = Lake.under(str(tmp_path / "lake"))
    source = write(tmp_path / "in" / "a.csv", [order("A"), "cut,off"])

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as broken:
        broken.setattr(stages, "overwrite", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            stages.bronze_to_silver(spark, lake, source_path=source)
    assert quarantined(spark, lake) == ["cut,off"]
    assert stages.bronze_to_silver(spark, lake, source_path=source) == {"quarantined": 1, "silver": 1}
    assert quarantined(spark, lake) == ["cut,off"]


def test_a_delivery_written_again_is_another_batch(spark, tmp_path):
    source = tmp_path / "in" / "a.csv"
    before = ledger.batch_id(spark, write(source, [order("A")]))
    assert ledger.batch_id(spark, str(source)) == before == ledger.batch_id(spark, str(source.parent))
    write(source, [order("A"), order("B")])
    after = ledger.batch_id(spark, str(source))
    assert after != before
    write(tmp_path / "in" / "b.csv", [order("C")])
    assert ledger.batch_id(spark, str(source.parent)) not in (before, after)


def test_a_batch_replaces_itself_only(spark, tmp_path):
    path = str(tmp_path / "bad")
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "n int, t string")
    assert ledger.replace_batch(rows, path, "one") == 2
    assert ledger.replace_batch(rows.where("n = 1"), path, "two") == 1
    assert ledger.replace_batch(rows.where("n = 2"), path, "one") == 1
    assert sorted(map(tuple, ledger.read_batches(spark, path).collect())) == [(1, "x", "two"), (2, "y", "one")]
    assert ledger.replace_batch(rows.where("n > 5"), path, "one") == 0
    assert [tuple(r) for r in ledger.read_batches(spark, path).collect()] == [(1, "x", "two")]


# --- landing ----------------------------------------------------------------------------------


def test_only_new_and_changed_files_land(spark, tmp_path):
    lake, source = Lake.under(str(tmp_path / "lake")), tmp_path / "delivery"
    day = lambda n: land(spark, lake, "orders", str(source), dt.date(2031, 5, n))
    status = lambda n: {r.file_name: r.status for r in day(n).collect()}
    for name in ("a.csv", "b.csv", "deep/c.csv"):
        write(source / name, [order(name)])
    assert status(1) == {"a.csv": "new", "b.csv": "new", "deep/c.csv": "new"}
    write(source / "b.csv", [order("changed")])
    write(source / "d.csv", [order("d")])
    assert status(2) == {"a.csv": "unchanged", "b.csv": "changed", "deep/c.csv": "unchanged", "d.csv": "new"}
    assert set(status(3).values()) == {"unchanged"}
    landed = {str(p.relative_to(tmp_path / "lake/bronze/raw/orders")) for p in (tmp_path / "lake/bronze/raw/orders").rglob("[!._]*.csv")}
    assert landed == {"2031/05/01/a.csv", "2031/05/01/b.csv", "2031/05/01/deep/c.csv", "2031/05/02/b.csv", "2031/05/02/d.csv"}
    assert (tmp_path / "lake/bronze/raw/orders/2031/05/02/b.csv").read_text() == (source / "b.csv").read_text()
    # back to what it was on the first day: changed again, whatever day it is
    write(source / "b.csv", [order("b.csv")])
    assert status(1)["b.csv"] == "changed" and set(status(1).values()) == {"unchanged"}


# --- documents --------------------------------------------------------------------------------


def test_documents_that_are_not_json_are_kept(spark, tmp_path):
    good = [{"id": 1, "name": "x", "extra": [1]}, {"id": "2", "name": None}, {"name": 3.5}]
    texts = {
        "array": json.dumps(good, indent=2), "one": '{"id": 7,\n "name": "y"}\n', "none": "[]", "cut": '[{"id": 1},\n {"id": 2',
        "more": '{"id": 1} {"id": 2}', "two": '{"id": 1}, {"id": 2}', "closed": '{"id": 1}] [{"id": 2}', "open": '1} {"v": 2', "empty": "", "word": "true", "mixed": '[{"id": 8}, 5, null]',
    }
    for name, text in texts.items():
        (tmp_path / f"f={name}").mkdir()
        (tmp_path / f"f={name}" / "doc.json").write_text(text)
    rows, broken = split_json_documents(spark, str(tmp_path), "id int, name string")
    assert sorted((r.f, r.id, r.name) for r in rows.where("id IS NOT NULL").collect()) == [
        ("array", 1, "x"), ("array", 2, None), ("mixed", 8, None), ("one", 7, "y"),
    ]
    assert [(r.f, r.name) for r in rows.where("id IS NULL").collect()] == [("array", "3.5")]
    found = sorted((r.f, r._corrupt_record) for r in broken.collect())
    whole = ["cut", "more", "two", "closed", "open"]
    # Spark's text scan leaves out files without any byte
    assert [f for f in found if f[0] not in ("mixed", "word", "empty")] == sorted((n, texts[n]) for n in whole)
    assert [f for f in found if f[0] in ("mixed", "word")] == [("mixed", "5"), ("mixed", "null"), ("word", "true")]


# --- order ------------------------------------------------------------------------------------


def test_positions_are_those_of_a_sort(spark):
    rows = [(i * 37 % 101, None if i % 9 == 0 else i % 5) for i in range(300)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "id int, a int, b int").repartition(7)
    got = numbered(df, F.desc("a"), F.col("b").asc_nulls_first(), "id").collect()
    want = sorted(range(300), key=lambda i: (-rows[i][0], -1 if rows[i][1] is None else rows[i][1], i))
    assert [r.id for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(1, 301))
    # one value everywhere, and no rows at all
    same = numbered(spark.range(50).select(F.lit(1).alias("x"), F.lit("y").alias("_place")), "x", name="n")
    assert sorted(r.n for r in same.collect()) == list(range(1, 51)) and same.columns == ["x", "_place", "n"]
    assert not numbered(df.where("id < 0"), "id").count()
    with pytest.raises(ValueError, match="position already"):
        numbered(df.withColumnRenamed("a", "Position"), "id")
