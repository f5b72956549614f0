"""What the footers of Parquet files say: rows and row groups, without reading any row."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_READ = "path string, length long, rows long, row_groups int"


def listed_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """``path, length`` of the files below ``path``; contents are not opened. Hidden files and folders are left out."""
    return (
        spark.read.format("binaryFile")
        .options(pathGlobFilter=glob, recursiveFileLookup=True)
        .load(path)
        .select("path", "length")
    )


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs
    from pyarrow import parquet as pq

    for batch in batches:
        rows, groups = [], []
        for path in batch.column(0).to_pylist():
            if path.startswith("file:"):
                path = "/" + path.removeprefix("file:").lstrip("/")
            system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
            with system.open_input_file(name) as file:
                found = pq.read_metadata(file)
            rows.append(found.num_rows)
            groups.append(found.num_row_groups)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(rows, pa.int64()), pa.array(groups, pa.int32())],
            names=["path", "length", "rows", "row_groups"],
        )


def file_footers(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, rows, row_groups``: one row per Parquet file below ``path``.

    File names are dealt to tasks, each of which reads the last bytes of its files; no record becomes a row, so a
    table of 100 TB costs one small read per file. A file that is no Parquet file is an error; a folder without
    files gives no rows.
    """
    return listed_files(spark, path).repartition("path").mapInArrow(_footers, _READ)
