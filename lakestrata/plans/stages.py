"""Layer-to-layer stages: raw files to silver tables, silver to gold marts, marts to the database.

Each raw file is scanned once per output (quarantine, silver): at scale a second parse costs about as
much as writing and reading back a parsed copy and needs no space. Both outputs come from one file
listing, so they describe the same files. A delivery that a stage has taken is noted in the lake's ledger, so
running it again, or after a run that stopped half way, changes nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.audit import with_ingest_audit
from ..operators import marts
from ..operators.split import split_invalid
from ..runtime import prepare, size_shuffles
from ..sinks.ledger import batch_id, done_counts, facts, note, replace_batch
from ..sinks.serving import Database, publish
from ..sinks.tables import append_evolving, append_quarantine, merge_into_path, overwrite, read_evolving, write_clustered
from ..sources.manifest import compare_manifests, file_manifest
from ..sources.raw import read_csv_permissive, read_json_documents
from ..sources.tables import Lake, require_table, table_exists
from . import orders, sales, trips


@dataclass(frozen=True)
class RawSet:
    """How one raw data set becomes a silver table."""

    schema: str
    key: str
    clean: Callable[[DataFrame], DataFrame]
    silver: str
    quarantine: str
    partition_by: Sequence[str]
    merge_keys: Sequence[str]
    raw: str


# Data set names, tables and default raw files.
RAW_SETS = {
    ("ecommerce", "orders"): RawSet(
        orders.RAW_SCHEMA,
        orders.KEY,
        orders.clean,
        "orders",
        "quarantine/corrupted_orders",
        orders.PARTITIONS,
        (orders.KEY,),
        "raw/ecommerce/olist_orders_dataset.csv",
    ),
    ("nyctaxi", "trips"): RawSet(
        trips.RAW_SCHEMA,
        trips.KEY,
        trips.clean,
        "nyc_taxi_trips",
        "quarantine/corrupted_nyctaxi",
        trips.PARTITIONS,
        (),
        "raw/nyctaxi/nyc_yellow_taxi_trips.csv",
    ),
}


@dataclass(frozen=True)
class Mart:
    """How one gold mart is built from a silver table and clustered."""

    dataset: str
    silver: str
    build: Callable[[DataFrame], DataFrame]
    partition_by: Sequence[str]
    cluster_by: Sequence[str]


# Mart names, layout and cluster columns.
MARTS = {
    "gold_daily_orders_summary": Mart(
        "ecommerce", "orders", marts.daily_orders, ("report_year", "report_month"), ("order_status",)
    ),
    "gold_daily_zone_metrics": Mart(
        "nyctaxi", "nyc_taxi_trips", marts.daily_zones, ("report_year", "report_month"), ("PULocationID", "payment_type")
    ),
}
SALES_MARTS = {"gold_daily_sales": marts.daily_sales, "gold_customer_metrics": marts.customer_value}


def datasets(choice: str) -> list[str]:
    known = list(dict.fromkeys(dataset for dataset, _ in RAW_SETS))
    if choice == "all":
        return known
    if choice not in known:
        raise ValueError(f"unknown dataset {choice!r}; use one of {known} or all")
    return [choice]


def check_landing(spark: SparkSession, source_path: str, landed_path: str, glob: str = "*.csv") -> DataFrame:
    """``file_name, status`` of a copied delivery: every file must have arrived unchanged."""
    return compare_manifests(file_manifest(spark, source_path, glob), file_manifest(spark, landed_path, glob))


def bronze_to_silver(
    spark: SparkSession,
    lake: Lake,
    dataset: str = "ecommerce",
    table: str | None = None,
    source_path: str | None = None,
    required: Sequence[str] = (),
    again: bool = False,
) -> dict[str, int]:
    """Quarantine bad rows, clean the others, merge (keyed sets) or replace the silver table.

    Returns ``{"quarantined": n, "silver": rows written}``. The files that ``source_path`` holds are one batch. One that is done is
    not taken again (``again`` does), and its counts are returned. A batch that was started only is run as a whole: its bad
    rows take the place of those an earlier run wrote, and a merge or a replaced table gives the same rows anyhow.
    """
    table = table or {"ecommerce": "orders", "nyctaxi": "trips"}.get(dataset, "")
    if (dataset, table) not in RAW_SETS:
        raise ValueError(f"unsupported dataset and table: {dataset}, {table}")
    plan = RAW_SETS[dataset, table]
    source_path = source_path or lake.path("bronze", plan.raw)
    prepare(spark)
    size_shuffles(spark, [source_path])
    ledger, batch = lake.path("silver", "_ledger/batches"), batch_id(spark, source_path)
    done = None if again else done_counts(spark, ledger, f"{dataset}/{table}", batch)
    # a set that is replaced as a whole holds the last delivery only, so an earlier one is not skipped
    if done and (plan.merge_keys or _last_batch(spark, ledger, f"{dataset}/{table}") == batch):
        return done
    note(spark, ledger, f"{dataset}/{table}", batch, "started", {"run": _runs_so_far(spark, ledger, f"{dataset}/{table}") + 1})
    raw = read_csv_permissive(spark, source_path, plan.schema, check_header=True)
    valid, bad = split_invalid(raw, plan.key, required)
    quarantine = lake.path("silver", plan.quarantine)
    quarantined = replace_batch(bad, quarantine, batch) if lake.fmt == "parquet" else append_quarantine(bad, quarantine, lake.fmt)
    clean, path = plan.clean(valid), lake.path("silver", plan.silver)
    if plan.merge_keys and table_exists(spark, path, lake.fmt):
        rows = merge_into_path(clean, path, plan.merge_keys, plan.partition_by, fmt=lake.fmt)
    else:
        rows = overwrite(clean, path, plan.partition_by, lake.fmt)
    counts = {"quarantined": quarantined, "silver": rows}
    note(spark, ledger, f"{dataset}/{table}", batch, "done", counts)
    return counts


def _runs_so_far(spark: SparkSession, ledger: str, dataset: str) -> int:
    started = facts(spark, ledger).where((F.col("dataset") == dataset) & (F.col("state") == "started"))
    return started.agg(F.max("row_count")).first()[0] or 0


def _last_batch(spark: SparkSession, ledger: str, dataset: str) -> str | None:
    """The batch of the run that was started last."""
    started = facts(spark, ledger).where((F.col("dataset") == dataset) & (F.col("state") == "started"))
    return started.agg(F.max_by("batch", "row_count")).first()[0]


def silver_to_gold(spark: SparkSession, lake: Lake, dataset: str = "ecommerce", only: str | None = None) -> dict[str, int]:
    """Rebuild the marts of a data set (or ``all``), or ``only`` one of them, clustered; returns rows per mart.

    Shuffles are sized by the silver table.
    """
    prepare(spark)
    wanted = datasets(dataset)
    written = {}
    for name, mart in MARTS.items():
        if mart.dataset in wanted and only in (None, name):
            silver = require_table(spark, lake.path("silver", mart.silver), lake.fmt)
            size_shuffles(spark, [lake.path("silver", mart.silver)])
            written[name] = write_clustered(
                mart.build(silver), lake.path("gold", name), mart.cluster_by, mart.partition_by, fmt=lake.fmt
            )
    return written


def ingest_json(
    spark: SparkSession,
    lake: Lake,
    source_path: str,
    table: str = "raw_orders",
    mode: str = "append",
    batch_id: str | None = None,
    multi_line: bool = True,
    schema: str | None = None,
) -> int:
    """Raw JSON documents to a bronze table with audit columns; ``append`` lets columns evolve."""
    prepare(spark)
    size_shuffles(spark, [source_path])
    rows = with_ingest_audit(read_json_documents(spark, source_path, schema, multi_line=multi_line), batch_id)
    path = lake.path("bronze", table)
    if mode == "append":
        return append_evolving(rows, path, lake.fmt)
    if mode == "overwrite":
        return overwrite(rows, path, fmt=lake.fmt)
    raise ValueError(f"unknown mode {mode!r}; use append or overwrite")


def sales_to_silver(spark: SparkSession, lake: Lake, bronze: str = "raw_orders", silver: str = "cleaned_orders") -> int:
    """Clean the bronze sales orders and merge them into the unpartitioned silver table."""
    prepare(spark)
    source = lake.path("bronze", bronze)
    require_table(spark, source, lake.fmt)
    size_shuffles(spark, [source])
    clean, path = sales.clean(read_evolving(spark, source, lake.fmt)), lake.path("silver", silver)
    if table_exists(spark, path, lake.fmt):
        return merge_into_path(clean, path, [sales.KEY], fmt=lake.fmt, evolve=True)
    return overwrite(clean, path, fmt=lake.fmt)


def sales_to_gold(
    spark: SparkSession, lake: Lake, silver: str = "cleaned_orders", database: Database | None = None
) -> dict[str, object]:
    """Daily sales and customer marts; with a database they are published from the stored marts, and a
    failed publish is reported while the marts stay."""
    prepare(spark)
    table = require_table(spark, lake.path("silver", silver), lake.fmt)
    size_shuffles(spark, [lake.path("silver", silver)])
    done: dict[str, object] = {}
    for name, build in SALES_MARTS.items():
        done[name] = overwrite(build(table), lake.path("gold", name), fmt=lake.fmt)
    for name in SALES_MARTS if database else ():
        done[f"{name} published"] = _try_publish(spark, lake, name, database, "overwrite")
    return done


def run_sales(
    spark: SparkSession, lake: Lake, stage: str = "all", source_path: str | None = None, database: Database | None = None
) -> dict[str, object]:
    """Sales stages ``bronze``, ``silver``, ``gold`` or ``all``."""
    if stage not in ("all", "bronze", "silver", "gold"):
        raise ValueError(f"unknown stage {stage!r}")
    done: dict[str, object] = {}
    if stage in ("all", "bronze"):
        done["bronze"] = ingest_json(spark, lake, source_path or lake.path("bronze", "raw/orders"))
    if stage in ("all", "silver"):
        done["silver"] = sales_to_silver(spark, lake)
    if stage in ("all", "gold"):
        done |= sales_to_gold(spark, lake, database=database)
    return done


def _try_publish(spark: SparkSession, lake: Lake, mart: str, database: Database, mode: str) -> object:
    try:
        return publish(require_table(spark, lake.path("gold", mart), lake.fmt), mart, database, mode)
    except Exception as error:  # noqa: BLE001 - one table's failure must not stop the others
        return f"failed: {error}"


def run_all(
    spark: SparkSession,
    lake: Lake,
    dataset: str = "all",
    sources: dict[str, str] | None = None,
    database: Database | None = None,
    mode: str = "upsert",
) -> DataFrame:
    """All stages; returns the run summary ``stage, item, row_count, seconds, status``."""
    summary = []

    def timed(stage: str, work: Callable[[], dict[str, object]]) -> None:
        start = time.monotonic()
        for item, result in work().items():
            rows, status = (result, "ok") if isinstance(result, int) else (None, str(result))
            summary.append((stage, item, rows, round(time.monotonic() - start, 3), status))

    for name in datasets(dataset):
        source = (sources or {}).get(name)
        timed("silver", lambda: {f"{name} {k}": n for k, n in bronze_to_silver(spark, lake, name, source_path=source).items()})
    for name, mart in MARTS.items():
        if mart.dataset in datasets(dataset):
            timed("gold", lambda: {name: silver_to_gold(spark, lake, dataset, only=name)[name]})
    for name, mart in MARTS.items():
        if mart.dataset in datasets(dataset):
            if database is None:
                summary.append(("serving", name, None, 0.0, "skipped"))
            else:
                timed("serving", lambda: {name: _try_publish(spark, lake, name, database, mode)})
    return spark.createDataFrame(summary, "stage string, item string, row_count long, seconds double, status string")
