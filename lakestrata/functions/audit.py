"""Audit and lineage columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stamp(df: DataFrame, name: str) -> DataFrame:
    """Add the query time as column ``name``."""
    return df.withColumn(name, F.current_timestamp())


def source_file() -> Column:
    """Path of the file a scanned row comes from."""
    return F.col("_metadata.file_path")


def with_ingest_audit(df: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Add ``_ingested_at``, ``_source_file`` and ``_batch_id`` (one id per call) to a file scan."""
    return df.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source_file": source_file(),
            "_batch_id": F.lit(batch_id or str(uuid.uuid4())),
        }
    )
