"""Layer table writers.

Row counts come from the write itself (an Observation in the last stage), not from a second scan.
There is no transaction log under plain Parquet: a replaced table appears by one rename, a merged
table changes partition by partition when the job commits. Use a Delta or Iceberg catalog table and
``operators.merge.merge_into_table`` where readers need snapshots.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.layout import clustered, sized
from ..operators.merge import key_faults, merge_into_table, merge_rows
from ..runtime import MB, hadoop_path, scratch_path
from ..sources.footers import listed_files
from ..sources.tables import read_table, table_exists


def _write(df: DataFrame, path: str, mode: str, fmt: str, partition_by: Sequence[str] = (), **options: object) -> int:
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return seen.get["rows"]


def _swap(spark: SparkSession, incoming: str, path: str) -> None:
    """Put the finished folder ``incoming`` in the place of ``path``."""
    fs, new = hadoop_path(spark, incoming)
    _, live = hadoop_path(spark, path)
    _, old = hadoop_path(spark, f"{path}.retired-{uuid.uuid4().hex}")
    if fs.exists(live) and not fs.rename(live, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, live):
        fs.rename(old, live)
        raise OSError(f"cannot move the new table to {path}")
    fs.delete(old, True)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", arranged: bool = False) -> int:
    """Replace the table and its schema; returns the number of rows.

    The new table is written beside the old one and takes its place when complete, so a failed job
    leaves the old table as it was and ``df`` may read the table it replaces. ``arranged`` keeps the
    caller's row order instead of rebalancing.
    """
    spark = df.sparkSession
    out = df if arranged else sized(df, partition_by)
    if fmt != "parquet" or not table_exists(spark, path, fmt):
        return _write(out, path, "overwrite", fmt, partition_by, **({"overwriteSchema": True} if fmt == "delta" else {}))
    incoming = f"{path}.incoming-{uuid.uuid4().hex}"
    rows = _write(out, incoming, "overwrite", fmt, partition_by)
    _swap(spark, incoming, path)
    return rows


def _evolved(df: DataFrame, known: T.StructType) -> DataFrame:
    """``df`` with shared columns in the table's types; an unsafe change of type is an error."""
    types = {f.name.lower(): f.dataType for f in known}
    columns = []
    for f in df.schema:
        wanted = types.get(f.name.lower(), f.dataType)
        if wanted != f.dataType and not isinstance(f.dataType, T.NullType):
            widens = (isinstance(wanted, T.StringType) and isinstance(f.dataType, T.AtomicType)) or (
                isinstance(wanted, (T.LongType, T.DoubleType)) and isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType))
            )
            if not widens:
                raise ValueError(f"column {f.name}: table has {wanted.simpleString()}, rows have {f.dataType.simpleString()}")
        columns.append(F.col(f.name).cast(wanted) if wanted != f.dataType else F.col(f.name))
    return df.select(*[c.alias(f.name) for c, f in zip(columns, df.schema)])


def append_evolving(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> int:
    """Append rows whose columns may differ from the table's; read back with :func:`read_evolving`.

    Shared columns are brought to the table's type, new columns are added, missing ones read as NULL.
    """
    spark = df.sparkSession
    if fmt == "delta":
        return _write(df, path, "append", fmt, partition_by, mergeSchema=True)
    if table_exists(spark, path, fmt):
        df = _evolved(df, read_evolving(spark, path, fmt).schema)
    return _write(sized(df, partition_by), path, "append", fmt, partition_by)


def read_evolving(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All columns any append brought."""
    return read_table(spark, path, fmt, mergeSchema=True)


def append_quarantine(bad: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Append bad rows, packed into few files; returns how many there were."""
    return _write(sized(bad), path, "append", fmt)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and go on from the stored rows, so that several
    jobs can use them without computing them again and a lost executor costs a re-read only."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _any(conditions: Sequence[Column]) -> Column:
    """OR of the conditions as a balanced tree, so that thousands of partitions do not nest too deep."""
    if len(conditions) == 1:
        return conditions[0]
    middle = len(conditions) // 2
    return _any(conditions[:middle]) | _any(conditions[middle:])


def in_partitions(columns: Sequence[str], partitions: Iterable[tuple]) -> Column:
    """Partition filter for the given tuples of partition values (NULL included)."""
    tails: dict[object, set[tuple]] = {}
    for first, *rest in partitions:
        tails.setdefault(first, set()).add(tuple(rest))
    head, rest = F.col(columns[0]), columns[1:]
    if rest:
        return _any([head.eqNullSafe(F.lit(value)) & in_partitions(rest, below) for value, below in tails.items()])
    values = head.isin([value for value in tails if value is not None])
    return (values | head.isNull()) if None in tails else values


def merge_into_path(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    newer_than: str | None = None,
    evolve: bool = False,
    fmt: str = "parquet",
) -> int:
    """Upsert ``source`` into the table at ``path`` (created if missing); returns the rows written.

    A partitioned table is rewritten only where it has to be: in the partitions the source adds to
    and those that hold a matching key, since a row may move to another partition. A partition left
    without rows is removed, because a dynamic overwrite does not touch what it gets no rows for.
    Source keys must be unique and not NULL. Source columns that the table lacks are an error; ``evolve`` adds them
    to an unpartitioned table. A format with row-level operations of its own does the
    merge itself.
    """
    spark = source.sparkSession
    if fmt != "parquet" and newer_than:
        raise ValueError("newer_than works on parquet tables only")
    source = stage(source, "merge-source")
    faults = key_faults(source, keys).first()
    if faults.null_keys or faults.repeated_keys:
        raise ValueError(f"merge source: {faults.null_keys} rows with NULL keys, {faults.repeated_keys} repeated keys")
    if not table_exists(spark, path, fmt):
        return overwrite(source, path, partition_by, fmt)
    if fmt != "parquet":
        merge_into_table(source, f"{fmt}.`{path}`", keys)
        return source.count()
    target = read_table(spark, path, fmt)
    # partition values come from folder names: take their types from the source, not from a guess
    types = [source.schema[f.name] if f.name in partition_by else f for f in target.schema]
    target = spark.read.format(fmt).schema(T.StructType(types)).load(path)
    if not partition_by:
        return overwrite(merge_rows(target, source, keys, newer_than, evolve), path, (), fmt)

    # One row per partition folder, a list the driver keeps for every scan of the table anyway. Only keys
    # and partition columns are read, and the semi join lets Spark drop other keys before the shuffle.
    parts = list(partition_by)
    hit = (
        target.select(*keys, *parts)
        .join(source.select(*keys), list(keys), "left_semi")
        .groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    matched = {tuple(r[c] for c in parts): r["n"] for r in hit}
    added = {tuple(r) for r in source.select(*parts).distinct().collect()}
    touched = added | set(matched)
    if not touched:
        return 0
    before = target.where(in_partitions(parts, touched))
    merged = merge_rows(before, source, keys, newer_than)
    if newer_than is None:
        sizes = before.groupBy(*parts).agg(F.count(F.lit(1)).alias("n")).collect()
        filled = added | {values for r in sizes if r["n"] > matched.get(values := tuple(r[c] for c in parts), 0)}
    else:
        filled = {tuple(r) for r in merged.select(*parts).distinct().collect()}
    emptied = _folders(target, parts, set(matched) - filled)
    rows = _write(
        sized(merged, parts),
        path,
        "overwrite",
        fmt,
        parts,
        partitionOverwriteMode="dynamic",
    )
    _remove_folders(spark, emptied)
    return rows


def _folders(table: DataFrame, parts: Sequence[str], partitions: set[tuple]) -> list[str]:
    """The folders of the given partitions, as URIs; no column is read."""
    if not partitions:
        return []
    chosen = table.where(in_partitions(parts, partitions))
    folder = F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]*$", 1)
    return [r[0] for r in chosen.select(folder).distinct().collect()]


def _remove_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    for uri in folders:
        folder = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def small_file_partitions(spark: SparkSession, path: str, partition_by: Sequence[str], smaller_than: int = 64 * MB) -> DataFrame:
    """Partitions with more than one file below ``smaller_than`` bytes: ``files, bytes`` per partition."""
    files = (
        read_table(spark, path)
        .select(*partition_by, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
        .distinct()
    )
    return (
        files.groupBy(*partition_by)
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("size").alias("bytes"),
            F.count(F.when(F.col("size") < smaller_than, 1)).alias("small"),
        )
        .where("small > 1")
        .drop("small")
    )


def _bins(spark: SparkSession, path: str, smaller_than: int, filled: int) -> DataFrame:
    """``path, bin``: the small files that are to be put together, bins numbered from 0.

    Small files of a folder are laid end to end by name and cut every ``filled`` bytes, so a bin holds at most ``filled``
    and one small file more; a bin with a single file is left alone.
    """
    small = listed_files(spark, path).where(F.col("length") < smaller_than).withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]*$", 1))
    before = F.sum("length").over(W.partitionBy("folder").orderBy("path")) - F.col("length")
    cut = small.withColumn("part", F.floor(before / filled))
    several = cut.groupBy("folder", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    numbers = several.select("folder", "part", (F.row_number().over(W.orderBy("folder", "part")) - 1).alias("bin"))
    return cut.join(numbers, ["folder", "part"]).select("path", "bin")


def _finish_compaction(spark: SparkSession, path: str) -> None:
    """Take the old files away and put the new ones in; can be done again from any point, so a lost driver does no harm."""
    work = f"{path}/_compacting"
    fs, folder = hadoop_path(spark, work)
    if not fs.exists(folder):
        return
    if fs.exists(hadoop_path(spark, f"{work}/old/_SUCCESS")[1]):
        for r in spark.read.schema("path string").parquet(f"{work}/old").collect():
            fs.delete(hadoop_path(spark, r.path)[1], False)
        rows = f"{work}/rows"
        root = fs.makeQualified(hadoop_path(spark, rows)[1]).toString()
        new = fs.listFiles(hadoop_path(spark, rows)[1], True)
        while new.hasNext():
            source = new.next().getPath()
            if source.getName().endswith(".parquet"):
                target = hadoop_path(spark, path + source.toString()[len(root) :])[1]
                fs.mkdirs(target.getParent())
                if not fs.rename(source, target):
                    raise OSError(f"cannot move {source} to {target}")
    fs.delete(folder, True)


def compact(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str] = (),
    smaller_than: int = 64 * MB,
    max_records: int = 0,
    fmt: str = "parquet",
    filled: int = 512 * MB,
) -> int:
    """Put small files together into ones of about ``filled`` bytes; returns the rows rewritten.

    Only files below ``smaller_than`` that have others in their folder to join are read and written, in partitioned and other
    tables alike; all others keep their names. The new files and the list of those they replace are complete in the
    hidden folder ``_compacting`` before anything is moved: a run that is lost after that is finished by the next one, one
    lost before it is forgotten. The driver handles names of small files only, a part of every listing of the table.
    """
    if fmt == "delta":
        spark.sql(f"OPTIMIZE delta.`{path}`")
        return 0
    _finish_compaction(spark, path)
    # partition values stay the text of their folders
    known_types = read_table(spark, path, fmt).schema
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in partition_by else f for f in known_types])
    bins = stage(_bins(spark, path, smaller_than, filled), "bins")
    found = bins.select("path").collect()
    if not found:
        return 0
    count = bins.agg(F.max("bin")).first()[0] + 1
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[r.path for r in found])
    file = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    known = bins.select(F.col("path").alias("_file"), F.col("bin").cast("int").alias("_bin"))
    put = rows.withColumn("_of", file).join(known, F.col("_of") == F.col("_file")).repartitionById(count, F.col("_bin")).drop("_of", "_file", "_bin")
    done = _write(put, f"{path}/_compacting/rows", "overwrite", fmt, partition_by, maxRecordsPerFile=max_records)
    bins.select("path").write.parquet(f"{path}/_compacting/old")
    _finish_compaction(spark, path)
    return done


def write_clustered(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    partition_by: Sequence[str] = (),
    partitions: int | None = None,
    fmt: str = "parquet",
) -> int:
    """Replace the table with its rows clustered by ``columns`` (see ``operators.layout.clustered``).

    Finding the quantiles, sampling the ranges and writing each read the rows, so they are stored once
    first instead of being computed three times.
    """
    df = stage(df, "unclustered")
    return overwrite(clustered(df, columns, partition_by, partitions), path, partition_by, fmt, arranged=True)
