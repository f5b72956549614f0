"""The registered queries: every operator over whole given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.audit import with_ingest_audit
from lakestrata.functions.casts import is_blank, to_double, to_int, to_time
from lakestrata.functions.labels import code_label, iso_json
from lakestrata.operators import contracts, marts, quality, views
from lakestrata.operators.dedup import distinct_by, keep_first, latest_by
from lakestrata.operators.layout import clustering_depth
from lakestrata.operators.merge import merge_rows
from lakestrata.operators.order import numbered
from lakestrata.operators.split import rejects, rejects_by_reason, split_invalid
from lakestrata.plans import orders, sales, stages, trips
from lakestrata.runtime import scratch_path
from lakestrata.sinks import serving
from lakestrata.sinks.tables import (
    append_evolving,
    append_quarantine,
    compact,
    merge_into_path,
    overwrite,
    read_evolving,
    stage,
    write_clustered,
)
from lakestrata.sources.footers import file_footers, listed_files
from lakestrata.sources.landing import land
from lakestrata.sources.manifest import compare_manifests, file_manifest, table_metrics
from lakestrata.sources.raw import CORRUPT, SOURCE, read_csv_permissive, read_json_documents, split_json_documents
from lakestrata.sources.tables import Lake, preview, read_table, since

from .feeds import land_documents, land_events, land_orders, land_sales, land_trips, local_folder, raw, table, with_plain_names

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_CLOCK = ("_ingested_at", "_quarantined_at", "_gold_calculated_at", "_silver_processed_at")


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        local_folder(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def plain(df: DataFrame) -> DataFrame:
    """Without clock columns, timestamps as wall-clock values."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema
            if f.name not in _CLOCK
        ]
    )


def valid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_invalid(raw(spark, sf_dir, "orders"), orders.KEY)[0]


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.clean(valid_orders(spark, sf_dir))


def typed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.typed(split_invalid(raw(spark, sf_dir, "lineitem"), trips.KEY)[0])


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.clean(split_invalid(raw(spark, sf_dir, "lineitem"), trips.KEY)[0])


def silver_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.clean(raw(spark, sf_dir, "events"))


def orders_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_orders(silver_orders(spark, sf_dir))


def zones_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_zones(silver_trips(spark, sf_dir))


# --- sources ---------------------------------------------------------------------------------


@query
def csv_permissive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the landed CSV files, wrong-width lines kept with their text."""
    return read_csv_permissive(spark, land_orders(spark, sf_dir), orders.RAW_SCHEMA).drop(SOURCE)


@query
def csv_corrupt_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counting alone sees the wrong-width lines too."""
    scan = read_csv_permissive(spark, land_orders(spark, sf_dir), orders.RAW_SCHEMA)
    kinds = scan.groupBy(F.col(CORRUPT).isNotNull().alias("is_corrupt"), is_blank("order_id").alias("no_key"))
    return kinds.agg(F.count(F.lit(1)).alias("row_count"))


@query
def json_ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON feed appended to a bronze table with audit columns, read back."""
    rows = read_json_documents(spark, land_sales(spark, sf_dir), multi_line=False).drop("_ingested_at")
    path = scratch_path(spark, "bronze-sales")
    append_evolving(with_ingest_audit(rows, batch_id="batch-1"), path)
    return read_evolving(spark, path).select(
        "order_id",
        "customer_id",
        "amount",
        "status",
        "_batch_id",
        F.col("_source_file").endswith(".json").alias("from_file"),
        F.col("_ingested_at").isNotNull().alias("has_time"),
    )


@query
def json_documents_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-line JSON documents of all events: the rows of those that parse, the names of those that do not."""
    rows, broken = split_json_documents(spark, land_documents(spark, sf_dir), "event_id bigint, user_id bigint, event_type string, props string")
    kind = F.lit("row").alias("kind")
    bad = broken.select(F.lit("broken").alias("kind"), "doc", (F.length(CORRUPT) > 0).alias("has_text"))
    return rows.select(kind, "doc", "event_id", "user_id", "event_type", "props").unionByName(bad, allowMissingColumns=True)


@query
def dated_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landings of the events: all new, then some changed, some new, then the second delivery once more."""
    lake, (first, second) = _lake(spark), [with_plain_names(spark, root) for root in land_events(spark, sf_dir)]
    found = None
    for day, source in ((1, first), (2, second), (3, second)):
        status = land(spark, lake, "events", source, dt.date(2024, 2, day), "*.txt")
        there = status.groupBy("status").agg(F.count(F.lit(1)).alias("files")).withColumn("day", F.lit(day))
        found = there if found is None else found.unionByName(there)
    return found


@query
def append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends with different columns read back as one table."""
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "evolving")
    middle = F.lit(dt.datetime(2024, 1, 16))
    early, late = F.col("ts") < middle, F.col("ts") >= middle
    append_evolving(events.where(early).select("event_id", "event_type", F.col("user_id").alias("amount")), path)
    append_evolving(events.where(late).select("event_id", "props", F.col("user_id").cast("int").alias("amount")), path)
    return read_evolving(spark, path)


@query
def table_scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date-bounded read of a partitioned mart; older partitions are not opened."""
    path = scratch_path(spark, "daily-orders")
    overwrite(orders_mart(spark, sf_dir), path, ["report_year", "report_month"])
    mart = read_table(spark, path)
    return plain(since(mart, "order_date", dt.date(1999, 5, 17), "report_year", "report_month"))


@query
def mart_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 100 mart records by key."""
    return plain(preview(orders_mart(spark, sf_dir), ["order_date", "order_status"]))


@query
def mart_preview_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as JSON with ISO dates."""
    rows = orders_mart(spark, sf_dir).select("order_date", "order_status", "total_orders", "report_year")
    first = preview(rows, ["order_date", "order_status"])
    return first.select(iso_json(first).alias("record"))


@query
def file_manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings of the events compared day by day: same, altered or swapped lines, days left out and added."""
    before, after = [
        file_manifest(spark, root, "*.txt").withColumn("day", F.regexp_extract("file_name", r"d=([^/]+)/", 1))
        for root in land_events(spark, sf_dir)
    ]
    status = compare_manifests(before, after, key="day")
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("files"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@query
def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line digests of the landed files: total number of lines without the headers."""
    manifest = file_manifest(spark, land_orders(spark, sf_dir))
    lines = F.split("digest", ":")[0].cast("long") - 1
    return manifest.groupBy("method").agg(F.sum(lines).alias("line_count"))


@query
def layer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, files and bytes per layer table from the footers, beside the files whose scan counts other rows."""
    silver, gold = scratch_path(spark, "silver-orders"), scratch_path(spark, "gold-orders")
    overwrite(silver_orders(spark, sf_dir), silver, orders.PARTITIONS)
    overwrite(marts.daily_orders(read_table(spark, silver)), gold, ["report_year", "report_month"])
    tables = {("silver", "orders"): silver, ("gold", "gold_daily_orders_summary"): gold}
    metrics = table_metrics(spark, tables).select("layer", "table", "rows", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))
    faults, below = None, "[^/]*/[^/]*/[^/]*$"
    for (layer, name), path in tables.items():
        scanned = read_table(spark, path).groupBy(F.regexp_extract("_metadata.file_path", below, 0).alias("file")).agg(F.count(F.lit(1)).alias("scanned"))
        footers = file_footers(spark, path).select(F.regexp_extract("path", below, 0).alias("file"), F.col("rows").alias("told"))
        differing = F.count_if(~F.coalesce("scanned", F.lit(0)).eqNullSafe(F.col("told"))).alias("differing_files")
        one = footers.join(scanned, "file", "full_outer").agg(F.lit(layer).alias("layer"), F.lit(name).alias("table"), differing)
        faults = one if faults is None else faults.unionByName(one)
    return metrics.join(faults, ["layer", "table"])


# --- cleaning --------------------------------------------------------------------------------


@query
def quarantine_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_orders(spark, sf_dir)


@query
def quarantine_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad rows appended to a quarantine table, read back."""
    path = scratch_path(spark, "quarantine")
    append_quarantine(split_invalid(raw(spark, sf_dir, "orders"), orders.KEY)[1], path)
    return plain(read_table(spark, path))


@query
def required_columns_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of the split that also requires a customer; together they are the input."""
    valid, bad = split_invalid(raw(spark, sf_dir, "orders"), orders.KEY, ["customer_id"])
    sides = valid.withColumn("side", F.lit("valid")).unionByName(bad.withColumn("side", F.lit("bad")), allowMissingColumns=True)
    return plain(sides)


@query
def orders_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(orders.typed(valid_orders(spark, sf_dir)))


@query
def sales_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(silver_sales(spark, sf_dir))


@query
def trips_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(silver_trips(spark, sf_dir))


@query
def trips_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected trips with their reasons."""
    out = rejects(typed_trips(spark, sf_dir), trips.LOWER_BOUNDS, trips.SET_COLUMNS)
    reasons = F.concat_ws(", ", "_reasons").alias("reasons")
    return plain(out.withColumn("reasons", reasons).drop("_reasons"))


@query
def trips_rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects_by_reason(typed_trips(spark, sf_dir), trips.LOWER_BOUNDS, trips.SET_COLUMNS)


@query
def tolerant_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and times read from the odd spellings a text column holds."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.expr("' ' || cast(l_partkey AS string) || '.75 '").alias("fraction"),
        F.expr("'+' || cast(l_suppkey AS string)").alias("plus"),
        F.expr("cast(l_partkey AS string) || 'e1'").alias("exponent"),
        F.expr("'.' || cast(l_suppkey AS string)").alias("point"),
        F.expr("cast(l_shipdate AS string) || '+02:00'").alias("offset_time"),
    )
    return plain(
        items.select(
            "l_orderkey",
            "l_linenumber",
            to_int("fraction").alias("fraction_int"),
            to_int("plus").alias("plus_int"),
            to_int("exponent").alias("exponent_int"),
            to_int("point").alias("point_int"),
            to_double("fraction").alias("fraction_double"),
            to_double("exponent").alias("exponent_double"),
            to_time("offset_time").alias("utc_time"),
            to_time("plus").alias("no_time"),
        )
    )


# --- deduplication and merge -----------------------------------------------------------------


@query
def latest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest delivery per order id."""
    return plain(silver_orders(spark, sf_dir))


@query
def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per user and type."""
    return latest_by(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", "event_id")


@query
def largest_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line with the highest price per order and line number; true duplicates in the table tie."""
    return keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.desc("l_extendedprice")])


@query
def distinct_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vendor, pickup time and zone."""
    return plain(distinct_by(trips.in_bounds(typed_trips(spark, sf_dir)), trips.IDENTITY))


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both deliveries whole, cleaned: the second one has known ids and new ones, and lacks some of the first."""
    valid = valid_orders(spark, sf_dir)
    return tuple(orders.clean(valid.where(F.col(SOURCE) == day)) for day in ("day1.csv", "day2.csv"))


@query
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second batch merged into the first."""
    first, second = _batches(spark, sf_dir)
    return plain(merge_rows(first, second, [orders.KEY]))


@query
def merge_newer_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, but an older purchase time does not replace a newer one."""
    first, second = _batches(spark, sf_dir)
    return plain(merge_rows(first, second, [orders.KEY], newer_than="order_purchase_timestamp"))


@query
def merge_table_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge into a partitioned table, run twice; rows that moved to another month leave no copy."""
    first, second = _batches(spark, sf_dir)
    path = scratch_path(spark, "merged-orders")
    overwrite(first, path, orders.PARTITIONS)
    merge_into_path(second, path, [orders.KEY], orders.PARTITIONS)
    merge_into_path(second, path, [orders.KEY], orders.PARTITIONS)
    return plain(read_table(spark, path))


@query
def merge_table_unpartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of the second half of the month merged into those of the first."""
    bronze = raw(spark, sf_dir, "events")
    middle = F.lit(dt.datetime(2024, 1, 16))
    path = scratch_path(spark, "merged-sales")
    merge_into_path(sales.clean(bronze.where(F.col("_ingested_at") < middle)), path, [sales.KEY])
    merge_into_path(sales.clean(bronze.where(F.col("_ingested_at") >= middle)), path, [sales.KEY])
    return plain(read_table(spark, path))


# --- marts -----------------------------------------------------------------------------------


@query
def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(orders_mart(spark, sf_dir))


@query
def daily_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(zones_mart(spark, sf_dir))


@query
def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(marts.daily_sales(silver_sales(spark, sf_dir)))


@query
def customer_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(marts.customer_value(silver_sales(spark, sf_dir)))


@query
def orders_by_month_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = marts.orders_by_month_status(silver_orders(spark, sf_dir))
    return numbered(counts, F.desc("order_year"), F.desc("order_month"), F.col("order_status").asc_nulls_last())


# --- views -----------------------------------------------------------------------------------


@query
def monthly_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(views.monthly_trends(orders_mart(spark, sf_dir)), F.desc("report_year"), F.desc("report_month"))


@query
def zone_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(views.zone_revenue(zones_mart(spark, sf_dir)), F.col("total_zone_revenue").desc_nulls_first(), "pulocationid")


@query
def top_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.top_zones(zones_mart(spark, sf_dir))


@query
def status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.label_totals(orders_mart(spark, sf_dir), "order_status", "total_orders")


@query
def payment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = code_label("payment_type", {1: "Credit Card"}, "Cash")
    return views.label_totals(zones_mart(spark, sf_dir), label, "total_trips")


@query
def delivery_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.delivery_report(orders_mart(spark, sf_dir), dt.date(1998, 1, 1))


@query
def high_value_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plain(views.high_value_customers(marts.customer_value(silver_sales(spark, sf_dir))))
    return numbered(rows, F.desc("total_lifetime_spend"), F.col("customer_id").asc_nulls_last())


@query
def record_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mart rows that mention 1999-1 in any column."""
    return views.search(plain(orders_mart(spark, sf_dir)), "1999-1")


@query
def sorted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plain(views.sort_by(orders_mart(spark, sf_dir), "total_orders", True, ["order_date", "order_status"]))
    return numbered(rows, F.desc("total_orders"), "order_date", F.col("order_status").asc_nulls_last())


@query
def chart_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = orders_mart(spark, sf_dir)
    return views.chart_points(mart, ["order_date", "order_status"], "order_date", ["total_orders"], ["avg_delivery_days"])


@query
def chart_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["pickup_date", "PULocationID", "payment_type"]
    return views.chart_points(zones_mart(spark, sf_dir), keys, "pickup_date", ["total_trips"], ["avg_trip_distance"])


@query
def global_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count, distinct keys and sum over the cleaned orders and their mart."""
    stored = stage(silver_orders(spark, sf_dir), "silver")
    silver = views.totals(stored, distinct={"distinct_orders": "order_id"})
    mart = views.totals(marts.daily_orders(stored), sums={"mart_orders": "total_orders"})
    return silver.select(F.lit("silver").alias("layer"), "row_count", F.col("distinct_orders").alias("total")).unionByName(
        mart.select(F.lit("gold").alias("layer"), "row_count", F.col("mart_orders").alias("total"))
    )


# --- quality ---------------------------------------------------------------------------------


@query
def silver_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types, required values, uniqueness and presence of the cleaned orders."""
    silver = stage(silver_orders(spark, sf_dir), "silver")
    required = ["order_id", "customer_id", "order_status", "order_purchase_timestamp"]
    return (
        quality.schema_check(silver, "orders", contracts.SILVER_ORDERS)
        .unionByName(quality.null_check(silver, "orders", required))
        .unionByName(quality.unique_check(silver, "orders", ["order_id"]))
        .unionByName(quality.not_empty_check(silver, "orders"))
    )


@query
def mart_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types, key values and value ranges of the daily orders mart."""
    mart = stage(orders_mart(spark, sf_dir), "mart")
    rules = {"total_orders > 0": F.col("total_orders") > 0, "avg_delivery_days >= 0": F.col("avg_delivery_days") >= 0}
    return (
        quality.schema_check(mart, "gold_daily_orders_summary", contracts.DAILY_ORDERS)
        .unionByName(quality.null_check(mart, "gold_daily_orders_summary", ["order_date", "order_status"]))
        .unionByName(quality.range_check(mart, "gold_daily_orders_summary", rules))
    )


@query
def raw_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same checks where they find faults: the raw lines table and the raw trips."""
    items = table(spark, sf_dir, "lineitem")
    typed = stage(typed_trips(spark, sf_dir), "typed-trips")
    rules = {"fare_amount >= 0": F.col("fare_amount") >= 0, "trip_distance > 10": F.col("trip_distance") > 10}
    return (
        quality.unique_check(items, "lineitem", ["l_orderkey", "l_linenumber"])
        .unionByName(quality.null_check(typed, "trips", ["PULocationID", "trip_distance", "tolls_amount"]))
        .unionByName(quality.range_check(typed, "trips", rules))
    )


@query
def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that occur more than once."""
    return quality.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def reconcile_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned orders against the mart total, with the orders that have no day."""
    silver = stage(silver_orders(spark, sf_dir), "silver")
    return quality.reconcile(silver, marts.daily_orders(silver), "total_orders", "order_purchase_timestamp")


@query
def row_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows = bad rows + duplicates + kept rows."""
    return quality.row_balance(raw(spark, sf_dir, "orders"), silver_orders(spark, sf_dir), orders.KEY)


@query
def lost_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events a layer lost, changed or holds twice, named by row; the same table against itself adds none."""
    events = stage(table(spark, sf_dir, "events"), "events")
    value = F.when(F.col("event_id") % 101 == 5, F.col("value") + 1).otherwise(F.col("value")).alias("value")
    kept = events.where("event_id % 997 <> 3").select(*[value if c == "value" else F.col(c) for c in events.columns])
    layer = stage(kept.unionByName(events.where("event_id % 991 = 7")), "layer")
    found = quality.unequal_rows(events, layer, ["event_id"])
    return plain(found.unionByName(quality.unequal_rows(events, events.repartition(7), ["event_id"])))


# --- layout ----------------------------------------------------------------------------------


@query
def zorder_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone mart clustered by zone and payment type, read back."""
    path = scratch_path(spark, "zones-clustered")
    write_clustered(zones_mart(spark, sf_dir), path, ["PULocationID", "payment_type"], ["report_year", "report_month"])
    return plain(read_table(spark, path))


@query
def orders_zorder_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned orders clustered by customer and purchase time, read back."""
    path = scratch_path(spark, "orders-clustered")
    write_clustered(silver_orders(spark, sf_dir), path, ["customer_id", "order_purchase_timestamp"], orders.PARTITIONS)
    return plain(read_table(spark, path))


@query
def compact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table grown by several appends, compacted in place, read back."""
    path = scratch_path(spark, "many-files")
    events = table(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts"))
    for kind in ("view", "click"):
        events.where(F.col("event_type") == kind).write.partitionBy("day").mode("append").parquet(path)
    events.where(~F.col("event_type").isin("view", "click")).write.partitionBy("day").mode("append").parquet(path)
    compact(spark, path, ["day"])
    return read_table(spark, path)


@query
def compaction_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of an unpartitioned table before and after compaction; its large file keeps its name."""
    path = scratch_path(spark, "small-files")
    events = stage(table(spark, sf_dir, "events"), "events")
    events.coalesce(1).write.parquet(path)
    large = listed_files(spark, path).first()
    for rest in (1, 2, 3):
        events.where(F.col("event_id") % 20 == rest).coalesce(1).write.mode("append").parquet(path)
    files_before = listed_files(spark, path).count()
    rows = compact(spark, path, smaller_than=large.length, filled=1 << 40)
    after = listed_files(spark, path).agg(
        F.lit(files_before).alias("files_before"),
        F.count(F.lit(1)).alias("files_after"),
        F.count_if((F.col("path") == large.path) & (F.col("length") == large.length)).alias("untouched"),
        F.lit(rows).cast("long").alias("rows_rewritten"),
    )
    return after.withColumn("row_count", F.lit(read_table(spark, path).count()))


@query
def clustering_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of 16 files a value of each column meets, before and after clustering."""
    before, after = scratch_path(spark, "loose"), scratch_path(spark, "clustered")
    events = table(spark, sf_dir, "events")
    overwrite(events.repartition(16), before, arranged=True)
    write_clustered(events, after, ["user_id", "ts"], partitions=16)
    was, now = [clustering_depth(read_table(spark, p), ["user_id", "ts"]) for p in (before, after)]
    both = was.select("column", F.col("files").alias("files_before"), F.col("mean_depth").alias("was")).join(
        now.select("column", F.col("files").alias("files_after"), F.col("mean_depth").alias("now")), "column"
    )
    return both.select("column", "files_before", "files_after", (F.col("now") <= 10).alias("within_bound"), (F.col("now") < F.col("was")).alias("less"))


@query
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by a changed copy of itself."""
    path = scratch_path(spark, "replaced")
    events = table(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts"))
    overwrite(events, path, ["day"])
    overwrite(read_table(spark, path).withColumn("value", F.col("value") * 2), path, ["event_type"])
    return read_table(spark, path)


# --- serving ---------------------------------------------------------------------------------


@query
def serving_rows_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily orders in the names and types of the serving table."""
    return plain(serving.serving_rows(orders_mart(spark, sf_dir), "gold_daily_orders_summary"))


@query
def serving_rows_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone metrics in the names and types of the serving table."""
    return plain(serving.serving_rows(zones_mart(spark, sf_dir), "gold_daily_zone_metrics"))


@query
def serving_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraint and precision checks before publishing; trips with an unreadable payment type break the key."""
    mart = stage(zones_mart(spark, sf_dir), "serving")
    faults = serving.constraint_faults(serving.serving_rows(mart, "gold_daily_zone_metrics"), "gold_daily_zone_metrics")
    return faults.unionByName(serving.precision_faults(mart, "gold_daily_zone_metrics"))


@query
def publish_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a publish would do: rows, columns and statement."""
    return serving.dry_run(orders_mart(spark, sf_dir), "gold_daily_orders_summary")


# --- whole runs ------------------------------------------------------------------------------


def _lake(spark: SparkSession) -> Lake:
    return Lake.under(scratch_path(spark, "lake"))


@query
def orders_csv_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files to silver, twice, to gold; the mart read back, with the bad rows kept after both runs."""
    lake, source = _lake(spark), land_orders(spark, sf_dir)
    stages.bronze_to_silver(spark, lake, "ecommerce", source_path=source)
    stages.bronze_to_silver(spark, lake, "ecommerce", source_path=source)
    stages.silver_to_gold(spark, lake, "ecommerce")
    kept = read_table(spark, lake.path("silver", "quarantine/corrupted_orders")).count()
    return plain(read_table(spark, lake.path("gold", "gold_daily_orders_summary"))).withColumn("quarantined_rows", F.lit(kept).cast("long"))


@query
def trips_csv_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files to silver to gold; the mart read back."""
    lake = _lake(spark)
    stages.bronze_to_silver(spark, lake, "nyctaxi", source_path=land_trips(spark, sf_dir))
    stages.silver_to_gold(spark, lake, "nyctaxi")
    return plain(read_table(spark, lake.path("gold", "gold_daily_zone_metrics")))


@query
def sales_json_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files to bronze, silver and gold; the customer mart read back."""
    lake = _lake(spark)
    stages.ingest_json(spark, lake, land_sales(spark, sf_dir), multi_line=False)
    stages.sales_to_silver(spark, lake)
    stages.sales_to_gold(spark, lake)
    return plain(read_table(spark, lake.path("gold", "gold_customer_metrics")))


@query
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage summary of a whole run over both CSV sets."""
    sources = {"ecommerce": land_orders(spark, sf_dir), "nyctaxi": land_trips(spark, sf_dir)}
    return stages.run_all(spark, _lake(spark), "all", sources).select("stage", "item", "row_count", "status")
