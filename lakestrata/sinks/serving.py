"""Publishing marts to a relational database.

Executors write the rows in parallel to a staging table over JDBC. One set-based statement inside one
transaction then moves them to the serving table, so no rows pass through the driver and readers see
the old or the new state. Rows a retried task wrote to the staging table twice are identical, and the
statement takes distinct rows, so a lost executor leaves no duplicates.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.contracts import SERVING_TABLES, ServingTable
from ..operators.quality import repeated_keys
from .tables import stage


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def serving_table(name: str) -> ServingTable:
    if name not in SERVING_TABLES:
        raise ValueError(f"unknown table {name!r}; known tables are {sorted(SERVING_TABLES)}")
    return SERVING_TABLES[name]


def serving_rows(df: DataFrame, table: str) -> DataFrame:
    """The mart as the serving table stores it: lower-case names, the table's types and precision.

    A column the table lacks is an error. A value that does not fit its type becomes NULL here; ``precision_faults``
    counts those in the mart.
    """
    known = serving_table(table)
    rows = lower_names(df)
    if unknown := [c for c in rows.columns if c not in known.columns]:
        raise ValueError(f"{table} has no columns {unknown}")
    return rows.select([F.col(c).try_cast(known.spark_type(c)).alias(c) for c in rows.columns])


def constraint_faults(rows: DataFrame, table: str) -> DataFrame:
    """``constraint, violations`` for NOT NULL, text length and primary key. A required column that is missing
    counts every row."""
    known = serving_table(table)
    faults = {f"{c} not null": F.col(c).isNull() if c in rows.columns else F.lit(True) for c in known.required}
    faults |= {f"{c} at most {n}": F.length(c) > n for c, n in known.max_lengths().items() if c in rows.columns}
    entries = [
        F.struct(F.lit(label).alias("constraint"), F.coalesce(F.count(F.when(bad, 1)), F.lit(0)).alias("violations"))
        for label, bad in faults.items()
    ]
    checks = rows.agg(F.array(*entries).alias("all")).select(F.inline("all"))
    keys = repeated_keys(rows, known.key).agg(
        F.lit(f"primary key ({', '.join(known.key)})").alias("constraint"), F.count(F.lit(1)).alias("violations")
    )
    return checks.unionByName(keys)


def precision_faults(df: DataFrame, table: str) -> DataFrame:
    """``constraint, violations``: values of a mart that do not fit the type of their serving column."""
    known, rows = serving_table(table), lower_names(df)
    entries = [
        F.struct(
            F.lit(f"{c} fits {known.columns[c]}").alias("constraint"),
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(known.spark_type(c)).isNull()).alias("violations"),
        )
        for c in rows.columns
        if c in known.columns
    ]
    return rows.agg(F.array(*entries).alias("all")).select(F.inline("all"))


def upsert_sql(table: str, columns: Sequence[str], keys: Sequence[str], staging: str, loaded_at: str = "_postgres_loaded_at") -> str:
    """One statement that moves the distinct rows of a staging table: new keys are added, rows of known keys take
    the staged values and a new load time. A table of keys alone has nothing to update."""
    names = ", ".join(columns)
    updates = {c: f"EXCLUDED.{c}" for c in columns if c not in keys}
    if updates:
        updates[loaded_at] = "CURRENT_TIMESTAMP"
    action = "UPDATE SET " + ", ".join(f"{c} = {value}" for c, value in updates.items()) if updates else "NOTHING"
    return f"INSERT INTO {table} ({names}) SELECT DISTINCT {names} FROM {staging} ON CONFLICT ({', '.join(keys)}) DO {action}"


def replace_sql(table: str, columns: Sequence[str], staging: str) -> list[str]:
    """Empty the table and fill it from the staging table."""
    names = ", ".join(columns)
    return [f"TRUNCATE TABLE {table}", f"INSERT INTO {table} ({names}) SELECT DISTINCT {names} FROM {staging}"]


def publish_statements(table: str, columns: Sequence[str], staging: str, mode: str, schema: str = "public") -> list[str]:
    """The statements of one publish, to be run in one transaction."""
    known = serving_table(table)
    full = f"{schema}.{table}"
    if mode == "overwrite":
        return replace_sql(full, columns, staging)
    if mode == "upsert":
        return [upsert_sql(full, columns, known.key, staging, known.loaded_at)]
    raise ValueError(f"unknown mode {mode!r}; use upsert or overwrite")


def create_table_sql(table: str, schema: str = "public") -> str:
    """DDL with types, NOT NULL, defaults and the primary key."""
    known = serving_table(table)
    rules = {c: " NOT NULL" * (c in known.required) + (f" DEFAULT {d}" if (d := known.default(c)) else "") for c in known.columns}
    lines = [f"{c} {kind}{rules[c]}" for c, kind in known.columns.items()]
    lines.append(f"{known.loaded_at} TIMESTAMPTZ NOT NULL DEFAULT CURRENT_TIMESTAMP")
    lines.append(f"PRIMARY KEY ({', '.join(known.key)})")
    return f"CREATE TABLE IF NOT EXISTS {schema}.{table} ({', '.join(lines)})"


@dataclass(frozen=True)
class Database:
    """A JDBC database that the driver and every executor can reach."""

    url: str
    driver: str = "org.postgresql.Driver"
    schema: str = "public"
    properties: dict[str, str] = field(default_factory=dict)
    writers: int = 16
    batch_size: int = 1000

    def options(self, table: str) -> dict[str, object]:
        return {
            **self.properties,
            "url": self.url,
            "driver": self.driver,
            "dbtable": table,
            "batchsize": self.batch_size,
            "numPartitions": self.writers,
        }

    def connect(self, spark: SparkSession):
        """JDBC connection of the driver program, through the class loader that holds the jars."""
        jvm = spark._jvm
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        properties = jvm.java.util.Properties()
        for name, value in self.properties.items():
            properties.setProperty(name, str(value))
        connection = loader.loadClass(self.driver).newInstance().connect(self.url, properties)
        if connection is None:
            raise ValueError(f"driver {self.driver} does not accept this JDBC URL")
        return connection

    def run(self, spark: SparkSession, statements: Sequence[str]) -> None:
        """Run the statements in one transaction; any error rolls all of them back."""
        connection = self.connect(spark)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for text in statements:
                statement.execute(text)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()


def write_jdbc(
    df: DataFrame, database: Database, table: str, mode: str = "overwrite", truncate: bool = True, **options: str
) -> int:
    """Plain parallel JDBC write; ``overwrite`` empties the table and keeps its DDL unless told otherwise."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("jdbc").options(**database.options(table))
    if mode == "overwrite":
        writer = writer.option("truncate", truncate)
    writer.options(**{name: value for name, value in options.items() if value}).mode(mode).save()
    return seen.get["rows"]


def publish(
    df: DataFrame,
    table: str,
    database: Database,
    mode: str = "upsert",
    run: Callable[[SparkSession, Sequence[str]], None] | None = None,
) -> int:
    """Publish a mart so that doing it twice leaves the same rows; returns the number of rows.

    An empty mart changes nothing. A mart that breaks the table's constraints is refused before
    anything is written. The rows are stored once first: the check, the write and any retried task
    then see the same values, also for clock columns.
    """
    spark = df.sparkSession
    run = run or database.run
    rows = stage(serving_rows(df, table), "serving")
    broken = precision_faults(df, table).unionByName(constraint_faults(rows, table)).where("violations > 0").collect()
    if broken:
        raise ValueError(f"{table}: " + "; ".join(f"{r.constraint}: {r.violations} violations" for r in broken))
    known = serving_table(table)
    staging = f"{database.schema}.{table}_staging_{uuid.uuid4().hex[:12]}"
    statements = publish_statements(table, rows.columns, staging, mode, database.schema)
    try:
        count = write_jdbc(rows, database, staging, createTableColumnTypes=_create_types(known, rows.columns))
        if count:
            run(spark, statements)
    finally:
        run(spark, [f"DROP TABLE IF EXISTS {staging}"])
    return count


def _create_types(known: ServingTable, columns: Sequence[str]) -> str:
    """Text lengths of the staging table; Spark derives the other types from the cast columns."""
    return ", ".join(f"{c} {known.columns[c]}" for c in columns if c in known.max_lengths())


def dry_run(df: DataFrame, table: str, schema: str = "public") -> DataFrame:
    """``table, row_count, columns, statement``: what a publish would do, without a connection.

    The statement is the one publish runs, with ``<table>_staging`` for its staging table.
    """
    rows = serving_rows(df, table)
    statements = publish_statements(table, rows.columns, f"{schema}.{table}_staging", "upsert", schema)
    return df.agg(
        F.lit(table).alias("table"),
        F.count(F.lit(1)).alias("row_count"),
        F.lit(", ".join(f"{n.lower()} {t}" for n, t in df.dtypes)).alias("columns"),
        F.lit("; ".join(statements)).alias("statement"),
    )
