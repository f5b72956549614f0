import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.layout import clustered, sized, with_z_key
from lakestrata.sinks.tables import (
    append_evolving,
    append_quarantine,
    compact,
    in_partitions,
    merge_into_path,
    overwrite,
    read_evolving,
    small_file_partitions,
    write_clustered,
)
from lakestrata.sources.tables import read_table

T = "k string, v string, y int, m int"


def rows(spark, path):
    return sorted(tuple(r) for r in read_table(spark, path).select("k", "v", "y", "m").collect())


def folders(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).glob("y=*/m=*"))


def test_overwrite_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    assert overwrite(spark.range(10), path) == 10
    # the new rows are read from the table they replace
    assert overwrite(read_table(spark, path).where("id < 3").withColumn("p", F.lit("x")), path, ["p"]) == 3
    assert read_table(spark, path).columns == ["id", "p"] and read_table(spark, path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_failed_overwrite_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite(spark.range(5), path)
    with pytest.raises(Exception, match="boom"):
        overwrite(spark.range(5).select(F.raise_error(F.lit("boom")).alias("id")), path)
    assert read_table(spark, path).count() == 5


def test_append_evolves_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    append_evolving(spark.createDataFrame([(1, "a")], "id long, x string"), path)
    append_evolving(spark.createDataFrame([(2, 3, 4.5)], "id int, x int, z double"), path)
    got = read_evolving(spark, path)
    assert set(got.dtypes) == {("id", "bigint"), ("x", "string"), ("z", "double")}
    assert {(r.id, r.x, r.z) for r in got.collect()} == {(1, "a", None), (2, "3", 4.5)}
    with pytest.raises(ValueError, match="column id"):
        append_evolving(spark.createDataFrame([("q",)], "id string"), path)


def test_quarantine_appends(spark, tmp_path):
    path = str(tmp_path / "q")
    bad = spark.createDataFrame([("line",)], "_corrupt_record string")
    assert [append_quarantine(bad, path), append_quarantine(bad, path)] == [1, 1]
    assert append_quarantine(bad.where("false"), path) == 0
    assert read_table(spark, path).count() == 2


def test_merge_updates_inserts_and_keeps(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [("a", "1", 2021, 1), ("b", "1", 2022, 1), ("c", "1", 2022, 2), ("d", "1", 2023, 1)]
    assert merge_into_path(spark.createDataFrame(first, T), path, ["k"], ["y", "m"]) == 4
    # a leaves the only row place of 2021/1, b is updated, e is new, d's partition is not touched
    untouched = {p: p.stat().st_mtime_ns for p in Path(path).glob("y=2023/m=1/*.parquet")}
    change = spark.createDataFrame([("a", "2", 2022, 1), ("b", "2", 2022, 1), ("e", "2", 2024, 5)], T)
    expected = [("a", "2", 2022, 1), ("b", "2", 2022, 1), ("c", "1", 2022, 2), ("d", "1", 2023, 1), ("e", "2", 2024, 5)]
    for _ in range(2):
        merge_into_path(change, path, ["k"], ["y", "m"])
        assert rows(spark, path) == expected
    assert folders(path) == ["y=2022/m=1", "y=2022/m=2", "y=2023/m=1", "y=2024/m=5"]
    assert untouched == {p: p.stat().st_mtime_ns for p in Path(path).glob("y=2023/m=1/*.parquet")}


def test_guarded_merge_moves_and_keeps(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_into_path(spark.createDataFrame([("a", "1", 2021, 1), ("b", "5", 2021, 2)], T), path, ["k"], ["y", "m"])
    change = spark.createDataFrame([("a", "2", 2022, 1), ("b", "4", 2022, 1)], T)
    for _ in range(2):
        merge_into_path(change, path, ["k"], ["y", "m"], newer_than="v")
        assert rows(spark, path) == [("a", "2", 2022, 1), ("b", "5", 2021, 2)]
    assert folders(path) == ["y=2021/m=2", "y=2022/m=1"]


def test_merge_of_unpartitioned_table(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_into_path(spark.createDataFrame([("a", "1", 1, 1), ("b", "1", 1, 1)], T), path, ["k"])
    merge_into_path(spark.createDataFrame([("b", "2", 1, 1), ("c", "2", 1, 1)], T), path, ["k"])
    assert rows(spark, path) == [("a", "1", 1, 1), ("b", "2", 1, 1), ("c", "2", 1, 1)]


@pytest.mark.parametrize("bad", [[("a", "1", 1, 1), ("a", "2", 1, 1)], [(None, "1", 1, 1)]])
def test_merge_refuses_unclear_keys(spark, tmp_path, bad):
    with pytest.raises(ValueError, match="merge source"):
        merge_into_path(spark.createDataFrame(bad, T), str(tmp_path / "t"), ["k"])


def test_merge_keeps_text_partition_values(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, region string"
    merge_into_path(spark.createDataFrame([("a", "007"), ("b", "010")], schema), path, ["k"], ["region"])
    merge_into_path(spark.createDataFrame([("b", "007")], schema), path, ["k"], ["region"])
    got = spark.read.schema(schema).parquet(path)
    assert {tuple(r) for r in got.collect()} == {("a", "007"), ("b", "007")}
    assert [p.name for p in Path(path).glob("region=*")] == ["region=007"]


def test_compaction_rewrites_only_small_file_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).withColumn("p", F.col("id") % 3)
    for part in range(4):
        df.where(f"id % 4 = {part} AND p < 2").write.partitionBy("p").mode("append").parquet(path)
    df.where("p = 2").coalesce(1).write.partitionBy("p").mode("append").parquet(path)
    before = [p.name for p in Path(path).glob("p=2/*.parquet")]
    assert sorted(r.p for r in small_file_partitions(spark, path, ["p"]).collect()) == [0, 1]
    assert compact(spark, path, ["p"]) == 667
    assert [len(list(Path(path).glob(f"p={i}/*.parquet"))) for i in range(3)] == [1, 1, 1]
    assert before == [p.name for p in Path(path).glob("p=2/*.parquet")]
    assert read_table(spark, path).agg(F.sum("id")).first()[0] == sum(range(1000))
    assert compact(spark, path, ["p"]) == 0


def test_compaction_keeps_large_files_and_text_partitions(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k long, region string"
    for start in (0, 10, 20):
        rows = [(start + i, region) for i in range(5) for region in ("007", "a/b %", None)]
        spark.createDataFrame(rows, schema).coalesce(1).write.partitionBy("region").mode("append").parquet(path)
    spark.range(200_000).selectExpr("id + 1000 AS k", "'007' AS region").coalesce(1).write.partitionBy("region").mode("append").parquet(path)
    files = {p: p.stat().st_size for p in Path(path).glob("region=*/*.parquet")}
    large = max(files, key=files.get)
    assert compact(spark, path, ["region"], smaller_than=100_000) == 45
    assert large.exists() and len(list(Path(path).glob("region=*/*.parquet"))) == 4
    assert {p.name for p in Path(path).glob("region=*")} == {p.parent.name for p in files}
    assert not list(Path(path).glob("_compacting*"))
    got = spark.read.schema(schema).parquet(path).where("k < 1000").groupBy("region").agg(F.count("*"), F.sum("k")).collect()
    assert {tuple(r) for r in got} == {("007", 15, 180), ("a/b %", 15, 180), (None, 15, 180)}


def test_compaction_fills_files_to_a_size(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(800).repartition(8).write.parquet(path)
    size = max(p.stat().st_size for p in Path(path).glob("*.parquet"))
    before = {p.name for p in Path(path).glob("*.parquet")}
    rows = compact(spark, path, filled=2 * size)
    after = {p.name for p in Path(path).glob("*.parquet")}
    # a file that is left over alone keeps its name
    assert rows == 800 - 100 * len(before & after) and len(before & after) <= 1
    assert 3 <= len(after) <= 5 and read_table(spark, path).agg(F.sum("id")).first()[0] == sum(range(800))


@pytest.mark.parametrize("stopped_at", ["rows", "old", "moved"])
def test_a_compaction_that_was_stopped_is_finished_or_forgotten(spark, tmp_path, monkeypatch, stopped_at):
    path = str(tmp_path / "t")
    spark.range(100).repartition(5).write.parquet(path)
    names = sorted(str(p) for p in Path(path).glob("*.parquet"))
    spark.range(100).coalesce(1).write.parquet(f"{path}/_compacting/rows")
    if stopped_at != "rows":
        spark.createDataFrame([(f"file:{n}",) for n in names], "path string").write.parquet(f"{path}/_compacting/old")
    if stopped_at == "moved":
        for n in names[:3]:
            Path(n).unlink()
    compact(spark, path)
    assert len(list(Path(path).glob("*.parquet"))) == 1 and not list(Path(path).glob("_compacting*"))
    assert sorted(r.id for r in read_table(spark, path).collect()) == list(range(100))


def test_compaction_of_unpartitioned_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(10).write.parquet(path)
    assert compact(spark, path) == 100
    assert len(list(Path(path).glob("*.parquet"))) == 1 and read_table(spark, path).count() == 100


def _files_to_read(spark, path, column, value):
    """Files whose min/max range of the column holds the value."""
    import pyarrow.parquet as pq

    hits, files = 0, list(Path(path).rglob("*.parquet"))
    for file in files:
        data = pq.read_table(file, columns=[column])[column].to_pylist()
        hits += min(data) <= value <= max(data)
    return hits, len(files)


def test_z_order_narrows_every_column(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20_000).select(
        (F.xxhash64("id") % 1000).cast("int").alias("a"), F.concat(F.lit("c"), F.pmod(F.hash("id"), F.lit(500))).alias("b"), "id"
    )
    write_clustered(df, path, ["a", "b"], partitions=16)
    assert read_table(spark, path).exceptAll(df).count() == 0 and read_table(spark, path).count() == 20_000
    for column, value in (("a", 17), ("b", "c77")):
        hits, files = _files_to_read(spark, path, column, value)
        assert files == 16 and hits <= 8


def test_one_hot_value_is_cut_into_several_partitions(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).cast("int").alias("zone"), F.lit(1).alias("pay"), "id")
    for columns in (["zone"], ["zone", "pay"]):
        sizes = [r["count"] for r in clustered(df, columns, partitions=8).groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2 * 30_000 / 8


def test_z_key_orders_all_types(spark):
    df = spark.createDataFrame(
        [(i, float(i), f"{i:04d}", dt.date(2026, 1, 1) + dt.timedelta(i), dt.datetime(2026, 1, 1, i % 24)) for i in range(100)] + [(None,) * 5],
        "i int, f double, s string, d date, t timestamp",
    )
    for c in ("i", "f", "s", "d"):
        keys = [r.z for r in with_z_key(df, [c], "z").orderBy(F.asc_nulls_first(c)).collect()]
        assert keys == sorted(keys) and len(set(keys)) > 32 and keys[0] == 0
    assert with_z_key(df, ["t", "i"], "z").select("z").distinct().count() > 32


def test_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    df = session.range(200_000).select("id", F.xxhash64("id").alias("h"), F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 7).alias("p"))
    sized(df, ["p"]).write.partitionBy("p").parquet(path)
    assert len(list(Path(path).glob("p=1/*.parquet"))) > 4
    assert len(list(Path(path).glob("p=*/*.parquet"))) < 200


def test_partition_filter(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(400).selectExpr("id", "CASE WHEN id % 7 > 0 THEN cast(id % 7 AS int) END AS a", "cast(id % 50 AS int) AS b")
    overwrite(df, path, ["a", "b"])
    wanted = {(r.a, r.b) for r in df.where("id % 3 = 0").collect()}
    table = read_table(spark, path).where(in_partitions(["a", "b"], wanted))
    assert {(r.a, r.b) for r in table.collect()} == wanted
    text = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in text
    many = [(a, b) for a in range(100) for b in range(100)]
    assert spark.range(1).selectExpr("5 AS a", "7 AS b").where(in_partitions(["a", "b"], many)).count() == 1
