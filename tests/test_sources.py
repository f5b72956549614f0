import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lakestrata import runtime
from lakestrata.operators.split import split_invalid
from lakestrata.sources.jdbc import read_jdbc
from lakestrata.sources.footers import file_footers
from lakestrata.sources.manifest import compare_manifests, file_counts, file_manifest, table_metrics
from lakestrata.sources.raw import read_csv_permissive, read_json_documents
from lakestrata.sources.tables import Lake, abfss_uri, preview, read_table, register_table, require_table, since, table_exists

SCHEMA = "order_id STRING, customer_id STRING, status STRING"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wrong_width_rows_are_found_even_when_only_counted(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_id,customer_id,status\nA,c1,x\nB,c2\nC,c3,x,extra\n")
    valid, bad = split_invalid(read_csv_permissive(spark, str(tmp_path / "a.csv"), SCHEMA), "order_id")
    assert (valid.count(), bad.count()) == (1, 2)
    assert {r._corrupt_record for r in bad.collect()} == {"B,c2", "C,c3,x,extra"}
    assert valid.first()._source_file.endswith("/a.csv")


def test_header_check_refuses_swapped_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("customer_id,order_id,status\nc1,A,x\n")
    path = str(tmp_path / "a.csv")
    assert read_csv_permissive(spark, path, SCHEMA).first().order_id == "c1"
    with pytest.raises(Exception, match="header|Header"):
        read_csv_permissive(spark, path, SCHEMA, check_header=True).collect()


def test_json_documents(spark, tmp_path):
    (tmp_path / "many.json").write_text(json.dumps([{"order_id": 1, "x": {"y": 2}}, {"order_id": 2}], indent=1))
    (tmp_path / "one.json").write_text(json.dumps({"order_id": 3, "note": "n"}, indent=1))
    df = read_json_documents(spark, str(tmp_path))
    assert sorted(r.order_id for r in df.collect()) == [1, 2, 3] and set(df.columns) == {"order_id", "x", "note"}
    assert read_json_documents(spark, str(tmp_path), "order_id INT").columns == ["order_id"]


def test_lake_paths():
    assert abfss_uri("bronze", "acct.dfs.core.windows.net", "/raw/x") == "abfss://bronze@acct.dfs.core.windows.net/raw/x"
    lake = Lake.in_containers("acct.dfs.core.windows.net", {"gold": "marts"})
    assert lake.path("gold", "daily") == "abfss://marts@acct.dfs.core.windows.net/daily"
    local = Lake.under("/data/")
    assert local.path("silver", "/orders") == "/data/silver/orders" and local.path("silver") == "/data/silver"
    assert local.landing_path("ecommerce", dt.date(2026, 5, 7)) == "/data/bronze/raw/ecommerce/2026/05/07"
    with pytest.raises(ValueError, match="unknown layer"):
        local.path("iron")


def test_table_exists_and_require(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not table_exists(spark, path)
    with pytest.raises(FileNotFoundError, match="run the stage"):
        require_table(spark, path)
    spark.range(3).write.parquet(path)
    assert table_exists(spark, path) and not table_exists(spark, path, "delta")
    assert require_table(spark, path).count() == 3


def test_register_partitioned_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(path)
    assert register_table(spark, "registered_t", path).count() == 10
    assert register_table(spark, "registered_t", path).where("p = 1").count() == 5
    assert spark.sql("SELECT count(*) FROM registered_t").first()[0] == 10
    spark.sql("DROP TABLE registered_t")


def test_since_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.sql("SELECT explode(sequence(date'2025-11-01', date'2026-03-01')) AS d")
    days.select("d", F.year("d").alias("y"), F.month("d").alias("m")).write.partitionBy("y", "m").parquet(path)
    df = since(read_table(spark, path), "d", dt.date(2026, 1, 15), "y", "m")
    assert df.count() == 17 + 28 + 1
    text = plan(df)
    assert "PartitionFilters: []" not in text and "GreaterThanOrEqual(d,2026-01-15)" in text
    assert [r.d.day for r in preview(df, ["d"], 2).collect()] == [15, 16]
    assert "TakeOrderedAndProject" in plan(preview(df, ["d"], 2))


def test_manifest_matches_hashlib_and_finds_changes(spark, tmp_path):
    before, after = tmp_path / "before", tmp_path / "after"
    for folder in (before, after):
        folder.mkdir()
        (folder / "same.csv").write_text("id,name,value\n1,alpha,10.5\n2,beta,20.0\n")
        (folder / "big.csv").write_text("id\n" + "\n".join(str(i) for i in range(1000)))
        (folder / "skip.txt").write_text("x")
    (after / "big.csv").write_text("id\n" + "\n".join(str(i) for i in range(999)) + "\n998")
    (before / "gone.csv").write_text("a\n")
    (after / "new.csv").write_text("b\n")
    (before / "swap.csv").write_text("a\nb\nc\n")
    (after / "swap.csv").write_text("b\na\nc\n")
    (before / "end.csv").write_text("a\nb\nc\n")
    (after / "end.csv").write_text("a\rb\nc\n")
    rows = {r.file_name: r for r in file_manifest(spark, str(before)).collect()}
    assert set(rows) == {"same.csv", "big.csv", "gone.csv", "swap.csv", "end.csv"}
    assert rows["big.csv"].method == "lines" and rows["big.csv"].digest.startswith("1001:")
    for method in ("lines", "md5"):
        mine, theirs = [file_manifest(spark, str(f), method=method) for f in (before, after)]
        assert {r.file_name: r.status for r in compare_manifests(mine, theirs).collect()} == {
            "same.csv": "ok", "big.csv": "changed", "gone.csv": "missing", "new.csv": "unexpected", "swap.csv": "changed",
            "end.csv": "changed",
        }
    assert mine.where("file_name = 'same.csv'").first().digest == hashlib.md5((before / "same.csv").read_bytes()).hexdigest()
    counts = file_counts(spark, str(before)).first()
    assert counts.files == 5 and counts.folder.endswith("/before")


def test_manifest_names_files_relative_to_the_folder(spark, tmp_path):
    for day in ("d 1", "d+2"):
        (tmp_path / "in" / day).mkdir(parents=True)
        (tmp_path / "in" / day / "part.csv").write_text(f"id\n{day}\n")
    for method in ("lines", "md5"):
        names = [r.file_name for r in file_manifest(spark, str(tmp_path / "in"), method=method).collect()]
        assert sorted(names) == ["d 1/part.csv", "d+2/part.csv"]
        assert sorted(r.file_name for r in file_manifest(spark, f"{tmp_path}/in/*", method=method).collect()) == sorted(names)


def test_table_metrics(spark, tmp_path):
    full, empty = str(tmp_path / "full"), str(tmp_path / "empty")
    spark.range(100).repartition(3).write.parquet(full)
    spark.range(0).write.parquet(empty)
    rows = {r.table: r for r in table_metrics(spark, {("silver", "full"): full, ("gold", "empty"): empty}).collect()}
    assert (rows["full"].files, rows["full"].rows) == (3, 100) and rows["full"].bytes > 0
    assert rows["empty"].rows == 0


def test_file_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "CASE WHEN id < 30 THEN 'a b%' END AS p").coalesce(1).write.partitionBy("p").parquet(path)
    found = {(r.rows, r.row_groups) for r in file_footers(spark, path).collect()}
    assert found == {(30, 1), (70, 1)}
    (tmp_path / "none").mkdir()
    assert file_footers(spark, str(tmp_path / "none")).count() == 0


def test_jdbc_scan_needs_bounds(spark):
    with pytest.raises(ValueError, match="bounds"):
        read_jdbc(spark, "jdbc:x", "t", partition_column="id")


def test_shuffles_grow_with_the_input(spark, tmp_path, monkeypatch):
    tb = 10**12
    assert runtime.shuffle_settings(10 * runtime.MB) == {"partitions": 1, "split_bytes": 128 * runtime.MB}
    assert runtime.shuffle_settings(tb)["partitions"] == 7451
    assert runtime.shuffle_settings(100 * tb) == {"partitions": 32768, "split_bytes": 1_000_000_000}
    spark.range(10).write.parquet(str(tmp_path / "a" / "t"))
    assert runtime.input_bytes(spark, [str(tmp_path / "a" / "*")]) > 0
    session = spark.newSession()
    monkeypatch.setattr(runtime, "input_bytes", lambda *_: 100 * tb)
    runtime.size_shuffles(session, [])
    assert session.conf.get("spark.sql.shuffle.partitions") == "32768"
    monkeypatch.setattr(runtime, "input_bytes", lambda *_: 1)
    runtime.size_shuffles(session, [])
    assert session.conf.get("spark.sql.shuffle.partitions") == "32768"


def test_scratch_lies_in_the_shared_folder(spark):
    assert runtime.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert runtime.scratch_path(spark, "x") != runtime.scratch_path(spark, "x")


def test_line_digest_does_not_depend_on_the_splits(spark, tmp_path):
    (tmp_path / "f.csv").write_text("\n".join(f"line {i * 7919 % 1000}" for i in range(20_000)))
    whole = file_manifest(spark, str(tmp_path)).first().digest
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, 4096)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        assert file_manifest(spark, str(tmp_path)).first().digest == whole
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
