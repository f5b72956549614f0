"""Layer tables: where they live and how they are read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import hadoop_path

LAYERS = ("bronze", "silver", "gold", "checkpoint")


def abfss_uri(container: str, host: str, path: str = "") -> str:
    """``abfss://container@host/path``; a leading slash of ``path`` is dropped."""
    return f"abfss://{container}@{host}/{path.lstrip('/')}"


@dataclass(frozen=True)
class Lake:
    """Layer roots (any Hadoop URIs) and the table format."""

    roots: Mapping[str, str]
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def under(cls, root: str, fmt: str = "parquet") -> Lake:
        return cls({layer: f"{root.rstrip('/')}/{layer}" for layer in LAYERS}, fmt)

    @classmethod
    def in_containers(cls, host: str, containers: Mapping[str, str] | None = None, fmt: str = "parquet") -> Lake:
        """One storage container per layer, named like the layer unless given."""
        names = {layer: layer for layer in LAYERS} | dict(containers or {})
        return cls({layer: abfss_uri(name, host) for layer, name in names.items()}, fmt)

    def path(self, layer: str, name: str = "") -> str:
        if layer not in self.roots:
            raise ValueError(f"unknown layer {layer!r}; layers are {sorted(self.roots)}")
        return f"{self.roots[layer].rstrip('/')}/{name.lstrip('/')}".rstrip("/")

    def landing_path(self, dataset: str, day: dt.date) -> str:
        """Dated folder of one raw delivery."""
        return self.path("bronze", f"raw/{dataset}/{day:%Y/%m/%d}")


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """True when ``path`` holds a table: a transaction log for delta, else any visible entry."""
    fs, jpath = hadoop_path(spark, f"{path}/_delta_log" if fmt == "delta" else path)
    if not fs.exists(jpath):
        return False
    return fmt == "delta" or any(
        not status.getPath().getName().startswith(("_", ".")) for status in fs.listStatus(jpath)
    )


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: object) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def require_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan a table of the previous stage; missing is an error that says what to run."""
    if not table_exists(spark, path, fmt):
        raise FileNotFoundError(f"no table at {path}: run the stage that writes it first")
    return read_table(spark, path, fmt)


def since(df: DataFrame, column: str, day: dt.date, year: str | None = None, month: str | None = None) -> DataFrame:
    """Rows from ``day`` on. Naming the year and month partition columns derived from ``column``
    adds the partition filter, so older folders are never opened."""
    df = df.where(F.col(column) >= F.lit(day))
    if year and month:
        same_year = (F.col(year) == day.year) & (F.col(month) >= day.month)
        df = df.where((F.col(year) > day.year) | same_year)
    return df


def preview(df: DataFrame, keys: Sequence[str | Column], limit: int = 100) -> DataFrame:
    """First records in key order; a top-k, not a full sort."""
    return df.orderBy(*keys).limit(limit)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Make the table at ``path`` known to SQL under ``name`` unless it already is."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source=fmt)
        if fmt != "delta" and any(f.isPartition for f in spark.catalog.listColumns(name)):
            spark.catalog.recoverPartitions(name)
    return spark.table(name)
