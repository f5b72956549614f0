"""Oracle SQL of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

from lakestrata.operators.contracts import SERVING_TABLES
from lakestrata.plans.orders import RAW_COLUMNS, TIMES
from lakestrata.plans.trips import DOUBLES, INTEGERS
from lakestrata.plans.trips import RAW_COLUMNS as TRIP_COLUMNS

from .feeds import CUT_DAYS, DOCUMENT, EVENT_DAYS, raw_sql


DECIMAL = "DECIMAL(38, 12)"


def half_up(total: str, parts: str, digits: int) -> str:
    """``total / parts`` (a DECIMAL of 12 digits and a whole number) rounded half-up, in whole-number arithmetic."""
    step = 10 ** (12 - digits)
    whole = f"CAST(({total}) * {10**12} AS HUGEINT)"
    size = f"((2 * abs({whole}) + ({parts}) * {step}) // (2 * ({parts}) * {step}))"
    return f"CASE WHEN ({parts}) > 0 THEN sign({whole}) * CAST({size} AS DOUBLE) / {10**digits} END"


def decimal(x: str) -> str:
    """The number as it is written, so no unit of the package's own is used."""
    return f"CAST(CAST({x} AS VARCHAR) AS {DECIMAL})"


def sum2(x: str) -> str:
    return half_up(f"sum({decimal(x)})", "CAST(1 AS HUGEINT)", 2)


def avg2(x: str) -> str:
    return half_up(f"sum({decimal(x)})", f"CAST(count({x}) AS HUGEINT)", 2)


def nulls_last(columns) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in columns)


# --- common parts ----------------------------------------------------------------------------

BAD = "(_corrupt_record IS NOT NULL OR order_id IS NULL OR trim(order_id) = '')"
ORDER_COLUMNS = ", ".join(RAW_COLUMNS)
VALID_ORDERS = f"(SELECT {ORDER_COLUMNS}, _source_file FROM {raw_sql('orders')} r WHERE NOT {BAD})"


def typed_orders(source: str = VALID_ORDERS) -> str:
    times = ", ".join(f"TRY_CAST({c} AS TIMESTAMP) AS {c}" for c in TIMES)
    return f"""(SELECT *, CAST(coalesce(year(order_purchase_timestamp), 1970) AS INTEGER) AS order_year,
      CAST(coalesce(month(order_purchase_timestamp), 1) AS INTEGER) AS order_month
    FROM (SELECT trim(order_id) AS order_id, trim(customer_id) AS customer_id,
      lower(trim(order_status)) AS order_status, {times}, _source_file FROM {source} v) t)"""


def clean_orders(source: str = VALID_ORDERS) -> str:
    return f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id
      ORDER BY order_purchase_timestamp DESC NULLS LAST, _source_file DESC) AS rn
      FROM {typed_orders(source)} o) ranked WHERE rn = 1)"""


SILVER_ORDERS = clean_orders()

DAILY_ORDERS = f"""(SELECT CAST(order_purchase_timestamp AS DATE) AS order_date, order_status,
  count(order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
  {avg2("CASE WHEN order_status = 'delivered' THEN date_diff('day', CAST(order_purchase_timestamp AS DATE), CAST(order_delivered_customer_date AS DATE)) END")} AS avg_delivery_days,
  count(*) FILTER (WHERE order_status = 'delivered') AS delivered_orders,
  count(*) FILTER (WHERE order_status = 'canceled') AS cancelled_orders,
  CAST(year(CAST(order_purchase_timestamp AS DATE)) AS INTEGER) AS report_year,
  CAST(month(CAST(order_purchase_timestamp AS DATE)) AS INTEGER) AS report_month
  FROM {SILVER_ORDERS} s WHERE order_purchase_timestamp IS NOT NULL GROUP BY ALL)"""

def to_int(c: str) -> str:
    """Integer with the fraction cut off; NULL unless the text is sign, digits and an optional fraction."""
    text = f"trim({c})"
    whole = f"regexp_extract({text}, '^([+-]?[0-9]*)([.][0-9]*)?$', 1)"
    return f"""CASE WHEN regexp_full_match({text}, '[+-]?[0-9]+([.][0-9]*)?') THEN TRY_CAST({whole} AS INTEGER)
      WHEN regexp_full_match({text}, '[+-]?[.][0-9]+') THEN 0 END"""


def _trip_column(c: str) -> str:
    if c in INTEGERS:
        return f"{to_int(c)} AS {c}"
    if c in DOUBLES:
        return f"TRY_CAST({c} AS DOUBLE) AS {c}"
    return f"trim({c}) AS {c}" if c == "store_and_fwd_flag" else c


TYPED_TRIPS = f"""(SELECT {", ".join(_trip_column(c) for c in TRIP_COLUMNS)}, _source_file,
  TRY_CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
  TRY_CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime
  FROM {raw_sql('lineitem')} r
  WHERE _corrupt_record IS NULL AND VendorID IS NOT NULL AND trim(VendorID) <> '')"""

_TRIP_TIES = [c for c in TRIP_COLUMNS if c not in ("VendorID", "PULocationID")] + ["dropoff_datetime"]
DISTINCT_TRIPS = f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY VendorID, pickup_datetime, PULocationID ORDER BY {nulls_last(_TRIP_TIES)}) AS rn
  FROM {TYPED_TRIPS} t WHERE fare_amount >= 0 AND total_amount >= 0 AND trip_distance >= 0
  AND pickup_datetime IS NOT NULL) ranked WHERE rn = 1)"""

DAILY_ZONES = f"""(SELECT CAST(pickup_datetime AS DATE) AS pickup_date, PULocationID, payment_type,
  count(*) AS total_trips, {sum2("total_amount")} AS total_revenue, {avg2("trip_distance")} AS avg_trip_distance,
  {avg2("fare_amount")} AS avg_fare_per_trip, {avg2("tip_amount")} AS avg_tip_amount,
  CAST(year(CAST(pickup_datetime AS DATE)) AS INTEGER) AS report_year,
  CAST(month(CAST(pickup_datetime AS DATE)) AS INTEGER) AS report_month
  FROM {DISTINCT_TRIPS} t WHERE PULocationID IS NOT NULL GROUP BY ALL)"""


def clean_sales(bronze: str, ties: str) -> str:
    return f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {ties}) AS rn
      FROM (SELECT order_id, customer_id, TRY_CAST(amount AS DOUBLE) AS amount, lower(trim(status)) AS status,
        order_date, _ingested_at, TRY_CAST(order_date AS TIMESTAMP) AS order_timestamp
        FROM {bronze} b WHERE order_id IS NOT NULL) t) ranked WHERE rn = 1)"""


_SALES_TIES = nulls_last(["_ingested_at", "customer_id", "amount", "status", "order_date"])
SILVER_SALES = clean_sales(raw_sql("events"), _SALES_TIES)
_DONE = "CASE WHEN status = 'completed' THEN amount {other} END"


def customer_value(silver: str) -> str:
    return f"""(SELECT customer_id, count(order_id) AS total_orders,
      {sum2(_DONE.format(other="ELSE 0"))} AS total_lifetime_spend, {avg2(_DONE.format(other=""))} AS avg_order_value,
      max(order_timestamp) AS latest_order_timestamp FROM {silver} s GROUP BY customer_id)"""


CUSTOMER_VALUE = customer_value(SILVER_SALES)


def merged(first: str, second: str) -> str:
    return f"""SELECT * FROM {first} t WHERE NOT EXISTS (SELECT 1 FROM {second} s WHERE s.order_id = t.order_id)
      UNION ALL BY NAME SELECT * FROM {second} s2"""


_FIRST = clean_orders(f"(SELECT * FROM {VALID_ORDERS} a WHERE _source_file = 'day1.csv')")
_SECOND = clean_orders(f"(SELECT * FROM {VALID_ORDERS} a WHERE _source_file = 'day2.csv')")
_MERGED = merged(_FIRST, _SECOND)


def check_rows(check: str, table: str, source: str, faults: dict[str, str]) -> str:
    """One row per fault condition."""
    return " UNION ALL ".join(
        f"""SELECT '{check}' AS "check", '{table}' AS "table", '{name.replace("'", "''")}' AS "column",
        count(*) FILTER (WHERE {bad}) AS violations, count(*) FILTER (WHERE {bad}) = 0 AS passed FROM {source} x"""
        for name, bad in faults.items()
    )


def schema_rows(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT 'schema' AS "check", '{table}' AS "table", '{c}' AS "column", CAST(0 AS BIGINT) AS violations, true AS passed"""
        for c in columns
    )


def unique_rows(table: str, source: str, keys: list[str]) -> str:
    names = ", ".join(keys)
    spare = f"count(*) - count(DISTINCT ({names}))"
    return f"""SELECT 'unique' AS "check", '{table}' AS "table", '{names}' AS "column", {spare} AS violations, {spare} = 0 AS passed FROM {source} x"""


def blank(c: str) -> str:
    return f"{c} IS NULL OR trim(CAST({c} AS VARCHAR)) = ''"


def _csv_column(i: int, c: str) -> str:
    parts = f"nullif(split_part(_corrupt_record, ',', {i}), '')"
    return f"CASE WHEN _corrupt_record IS NULL THEN nullif({c}, '') ELSE {parts} END AS {c}"


_BASE_LINES = "(SELECT * FROM lineitem)"
_SEARCH = " OR ".join(
    f"lower(CAST({c} AS VARCHAR)) LIKE '%1999-1%'"
    for c in ("order_date", "order_status", "total_orders", "unique_customers", "avg_delivery_days", "report_year")
)
_SERVING_ORDERS = f"""SELECT order_date, order_status, total_orders, unique_customers,
  CAST(avg_delivery_days AS DECIMAL(8, 2)) AS avg_delivery_days, delivered_orders, cancelled_orders,
  report_year, report_month FROM {DAILY_ORDERS} m"""
_SERVING_ZONES = f"""SELECT pickup_date, PULocationID AS pulocationid, payment_type, total_trips,
  CAST(total_revenue AS DECIMAL(14, 2)) AS total_revenue, CAST(avg_trip_distance AS DECIMAL(8, 2)) AS avg_trip_distance,
  CAST(avg_fare_per_trip AS DECIMAL(10, 2)) AS avg_fare_per_trip, CAST(avg_tip_amount AS DECIMAL(10, 2)) AS avg_tip_amount,
  report_year, report_month FROM {DAILY_ZONES} m"""
_ZONE_REQUIRED = [
    "pickup_date",
    "pulocationid",
    "payment_type",
    "total_trips",
    "total_revenue",
    "avg_trip_distance",
    "avg_fare_per_trip",
    "avg_tip_amount",
    "report_year",
    "report_month",
]
_REJECT_RULES = [
    ("fare_amount missing", "fare_amount IS NULL"),
    ("fare_amount below 0", "fare_amount < 0"),
    ("total_amount missing", "total_amount IS NULL"),
    ("total_amount below 0", "total_amount < 0"),
    ("trip_distance missing", "trip_distance IS NULL"),
    ("trip_distance below 0", "trip_distance < 0"),
    ("pickup_datetime missing", "pickup_datetime IS NULL"),
]
_REASONS = ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in _REJECT_RULES)
_DRY_COLUMNS = (
    "order_date date, order_status string, total_orders bigint, unique_customers bigint, avg_delivery_days double, "
    "delivered_orders bigint, cancelled_orders bigint, report_year int, report_month int, _gold_calculated_at timestamp"
)
_DRY_STATEMENT = (
    "INSERT INTO public.gold_daily_orders_summary (order_date, order_status, total_orders, unique_customers, "
    "avg_delivery_days, delivered_orders, cancelled_orders, report_year, report_month, _gold_calculated_at) SELECT DISTINCT "
    "order_date, order_status, total_orders, unique_customers, avg_delivery_days, delivered_orders, cancelled_orders, "
    "report_year, report_month, _gold_calculated_at FROM public.gold_daily_orders_summary_staging "
    "ON CONFLICT (order_date, order_status) DO UPDATE SET total_orders = EXCLUDED.total_orders, "
    "unique_customers = EXCLUDED.unique_customers, avg_delivery_days = EXCLUDED.avg_delivery_days, "
    "delivered_orders = EXCLUDED.delivered_orders, cancelled_orders = EXCLUDED.cancelled_orders, "
    "report_year = EXCLUDED.report_year, report_month = EXCLUDED.report_month, "
    "_gold_calculated_at = EXCLUDED._gold_calculated_at, _postgres_loaded_at = CURRENT_TIMESTAMP"
)
_MIDDLE = "TIMESTAMP '2024-01-16 00:00:00'"
_EARLY = clean_sales(f"(SELECT * FROM {raw_sql('events')} e WHERE _ingested_at < {_MIDDLE})", _SALES_TIES)
_LATE = clean_sales(f"(SELECT * FROM {raw_sql('events')} e WHERE _ingested_at >= {_MIDDLE})", _SALES_TIES)
_SALES_OUT = "order_id, customer_id, amount, status, order_date, order_timestamp"
# ingested in one batch, so the other columns decide, in the order JSON inference names them
_JSON_SALES = clean_sales(raw_sql("events"), nulls_last(["amount", "customer_id", "order_date", "status"]))



def _too_wide(column: str, kind: str) -> str:
    """Marts are rounded to two digits, so a value fits unless it has too many before the point."""
    if not kind.startswith("NUMERIC"):
        return "false"
    digits, scale = (int(n) for n in kind[8:-1].split(","))
    return f"abs({column}) >= {10 ** (digits - scale)}"


ORACLES: dict[str, str] = {
    "csv_permissive_scan": f"""SELECT {", ".join(_csv_column(i, c) for i, c in enumerate(RAW_COLUMNS, 1))}, _corrupt_record
      FROM {raw_sql("orders")} r""",
    "csv_corrupt_count": f"""SELECT _corrupt_record IS NOT NULL AS is_corrupt,
      _corrupt_record IS NULL AND (order_id IS NULL OR trim(order_id) = '') AS no_key, count(*) AS row_count
      FROM {raw_sql("orders")} r GROUP BY ALL""",
    "json_ingest_audit": f"""SELECT order_id, customer_id, amount, status, 'batch-1' AS _batch_id, true AS from_file,
      true AS has_time FROM {raw_sql("events")} r""",
    "append_evolve": f"""SELECT event_id, CASE WHEN ts < {_MIDDLE} THEN event_type END AS event_type, user_id AS amount,
      CASE WHEN ts >= {_MIDDLE} THEN props END AS props FROM events""",
    "table_scan_pruned": f"SELECT * FROM {DAILY_ORDERS} m WHERE order_date >= DATE '1999-05-17'",
    "mart_preview": f"SELECT * FROM {DAILY_ORDERS} m ORDER BY order_date, order_status LIMIT 100",
    "mart_preview_json": f"""SELECT '{{"order_date":"' || CAST(order_date AS VARCHAR) || '","order_status":"' || order_status
      || '","total_orders":' || CAST(total_orders AS VARCHAR) || ',"report_year":' || CAST(report_year AS VARCHAR) || '}}' AS record
      FROM {DAILY_ORDERS} m ORDER BY order_date, order_status LIMIT 100""",
    "file_manifest_check": f"""SELECT CASE WHEN fate = 'altered' OR fate = 'swapped' AND n > 1 THEN 'changed'
        WHEN fate IN ('missing', 'unexpected') THEN fate ELSE 'ok' END AS status, count(*) AS files,
        CAST(min(d) AS STRING) AS first_day, CAST(max(d) AS STRING) AS last_day
      FROM ({EVENT_DAYS.format(events="events")}) x GROUP BY 1""",
    "landed_lines": "SELECT 'lines' AS method, CAST(2 * count(*) AS BIGINT) AS line_count FROM orders",
    "layer_metrics": f"""SELECT 'silver' AS layer, 'orders' AS "table", count(*) AS "rows", true AS has_files, true AS has_bytes,
      CAST(0 AS BIGINT) AS differing_files
      FROM {SILVER_ORDERS} s UNION ALL
      SELECT 'gold', 'gold_daily_orders_summary', count(*), true, true, CAST(0 AS BIGINT) FROM {DAILY_ORDERS} m""",
    "quarantine_valid": f"SELECT * FROM {VALID_ORDERS} v",
    "quarantine_bad": f"SELECT * FROM {raw_sql('orders')} r WHERE {BAD}",
    "required_columns_split": f"""SELECT *, CASE WHEN {BAD} OR customer_id IS NULL THEN 'bad' ELSE 'valid' END AS side FROM {raw_sql("orders")} r""",
    "orders_typed": f"SELECT * FROM {typed_orders()} t",
    "sales_clean": f"SELECT {_SALES_OUT} FROM {SILVER_SALES} s",
    "trips_clean": f"""SELECT *, CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
      CAST(month(pickup_datetime) AS INTEGER) AS pickup_month FROM {DISTINCT_TRIPS} t""",
    "trips_rejects": f"""SELECT *, concat_ws(', ', {_REASONS}) AS reasons FROM {TYPED_TRIPS} t
      WHERE NOT coalesce(fare_amount >= 0 AND total_amount >= 0 AND trip_distance >= 0 AND pickup_datetime IS NOT NULL, false)""",
    "trips_rejects_by_reason": " UNION ALL ".join(
        f"SELECT '{name}' AS reason, count(*) AS row_count FROM {TYPED_TRIPS} t WHERE {rule} HAVING count(*) > 0"
        for name, rule in _REJECT_RULES
    ),
    "tolerant_casts": """SELECT l_orderkey, l_linenumber, CAST(l_partkey AS INTEGER) AS fraction_int,
      CAST(l_suppkey AS INTEGER) AS plus_int, CAST(NULL AS INTEGER) AS exponent_int, CAST(0 AS INTEGER) AS point_int,
      CAST(l_partkey AS DOUBLE) + 0.75::DOUBLE AS fraction_double, CAST(l_partkey AS DOUBLE) * 10 AS exponent_double,
      l_shipdate - INTERVAL 2 HOUR AS utc_time, CAST(NULL AS TIMESTAMP) AS no_time FROM lineitem""",
    "latest_order": f"SELECT * FROM {SILVER_ORDERS} s",
    "latest_event": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
      ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM events) r WHERE rn = 1""",
    "largest_line": f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY {nulls_last(["l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"])}) AS rn
      FROM lineitem) r WHERE rn = 1""",
    "distinct_trips": f"SELECT * FROM {DISTINCT_TRIPS} t",
    "merge_upsert": _MERGED,
    "merge_newer_only": f"""SELECT * EXCLUDE (rn, side) FROM (SELECT *, row_number() OVER (PARTITION BY order_id
      ORDER BY order_purchase_timestamp DESC NULLS LAST, side DESC) AS rn
      FROM (SELECT *, 0 AS side FROM {_FIRST} f UNION ALL BY NAME SELECT *, 1 AS side FROM {_SECOND} g) u) r WHERE rn = 1""",
    "merge_table_twice": _MERGED,
    "merge_table_unpartitioned": f"SELECT {_SALES_OUT} FROM ({merged(_EARLY, _LATE)}) m",
    "daily_orders": f"SELECT * FROM {DAILY_ORDERS} m",
    "daily_zones": f"SELECT * FROM {DAILY_ZONES} m",
    "daily_sales": f"""SELECT CAST(order_timestamp AS DATE) AS order_day, count(order_id) AS total_orders,
      count(DISTINCT customer_id) AS unique_customers, {sum2(_DONE.format(other="ELSE 0"))} AS total_completed_revenue,
      count(*) FILTER (WHERE status = 'completed') AS completed_orders,
      count(*) FILTER (WHERE status = 'cancelled') AS cancelled_orders FROM {SILVER_SALES} s GROUP BY 1""",
    "customer_value": f"SELECT * FROM {CUSTOMER_VALUE} c",
    "orders_by_month_status": f"""SELECT order_year, order_month, order_status, count(order_id) AS order_count,
      row_number() OVER (ORDER BY order_year DESC, order_month DESC, order_status NULLS LAST) AS position
      FROM {SILVER_ORDERS} s GROUP BY order_year, order_month, order_status""",
    "monthly_trends": f"""SELECT report_year, report_month, CAST(sum(total_orders) AS BIGINT) AS monthly_orders,
      CAST(sum(delivered_orders) AS BIGINT) AS monthly_delivered, CAST(sum(cancelled_orders) AS BIGINT) AS monthly_cancelled,
      {avg2("avg_delivery_days")} AS avg_delivery_time_days,
      row_number() OVER (ORDER BY report_year DESC, report_month DESC) AS position FROM {DAILY_ORDERS} m GROUP BY report_year, report_month""",
    "zone_revenue": f"""SELECT *, row_number() OVER (ORDER BY total_zone_revenue DESC NULLS FIRST, pulocationid NULLS FIRST) AS position FROM (SELECT PULocationID AS pulocationid, CAST(sum(total_trips) AS BIGINT) AS total_trips,
      {sum2("total_revenue")} AS total_zone_revenue, {avg2("avg_fare_per_trip")} AS avg_zone_fare
      FROM {DAILY_ZONES} m GROUP BY PULocationID) z""",
    "top_zones": f"""SELECT PULocationID AS pickup_zone, CAST(sum(m.total_trips) AS BIGINT) AS total_trips,
      {sum2("m.total_revenue")} AS total_revenue, {avg2("avg_fare_per_trip")} AS avg_fare, {avg2("avg_tip_amount")} AS avg_tip
      FROM {DAILY_ZONES} m GROUP BY PULocationID
      ORDER BY {sum2("m.total_revenue")} DESC NULLS FIRST, PULocationID LIMIT 10""",
    "status_distribution": f"""SELECT order_status AS label, CAST(sum(total_orders) AS BIGINT) AS total
      FROM {DAILY_ORDERS} m GROUP BY 1""",
    "payment_distribution": f"""SELECT CASE WHEN payment_type = 1 THEN 'Credit Card' ELSE 'Cash' END AS label,
      CAST(sum(total_trips) AS BIGINT) AS total FROM {DAILY_ZONES} m GROUP BY 1""",
    "delivery_report": f"""SELECT order_date, order_status, total_orders, unique_customers,
      {half_up(decimal("avg_delivery_days"), "CAST(1 AS HUGEINT)", 1)} AS avg_delivery_days, delivered_orders
      FROM {DAILY_ORDERS} m WHERE order_date >= DATE '1998-01-01'""",
    "high_value_customers": f"""SELECT *, row_number() OVER (ORDER BY total_lifetime_spend DESC, customer_id NULLS LAST) AS position
      FROM {CUSTOMER_VALUE} c WHERE total_lifetime_spend > 200""",
    "record_search": f"SELECT * FROM {DAILY_ORDERS} m WHERE {_SEARCH}",
    "sorted_records": f"""SELECT *, row_number() OVER (ORDER BY total_orders DESC, order_date, order_status NULLS LAST) AS position
      FROM {DAILY_ORDERS} m""",
    "chart_orders": f"""SELECT CAST(order_date AS VARCHAR) AS label, total_orders AS volume,
      coalesce(nullif(avg_delivery_days, 0), 0) AS mean FROM {DAILY_ORDERS} m ORDER BY order_date, order_status LIMIT 15""",
    "chart_zones": f"""SELECT CAST(pickup_date AS VARCHAR) AS label, total_trips AS volume,
      coalesce(nullif(avg_trip_distance, 0), 0) AS mean
      FROM {DAILY_ZONES} m ORDER BY pickup_date, PULocationID, payment_type NULLS FIRST LIMIT 15""",
    "global_totals": f"""SELECT 'silver' AS layer, count(*) AS row_count, count(DISTINCT order_id) AS total FROM {SILVER_ORDERS} s
      UNION ALL SELECT 'gold', count(*), CAST(sum(total_orders) AS BIGINT) FROM {DAILY_ORDERS} m""",
    "silver_quality": " UNION ALL ".join(
        [
            schema_rows(
                "orders",
                ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_year", "order_month", "_ingested_at"],
            ),
            check_rows(
                "not_null",
                "orders",
                SILVER_ORDERS,
                {c: blank(c) for c in ("order_id", "customer_id", "order_status", "order_purchase_timestamp")},
            ),
            unique_rows("orders", SILVER_ORDERS, ["order_id"]),
            """SELECT 'not_empty', 'orders', '*', CAST(0 AS BIGINT), count(*) > 0 FROM orders""",
        ]
    ),
    "mart_quality": " UNION ALL ".join(
        [
            schema_rows(
                "gold_daily_orders_summary",
                [
                    "order_date",
                    "order_status",
                    "total_orders",
                    "unique_customers",
                    "avg_delivery_days",
                    "delivered_orders",
                    "cancelled_orders",
                    "report_year",
                    "report_month",
                    "_gold_calculated_at",
                ],
            ),
            check_rows("not_null", "gold_daily_orders_summary", DAILY_ORDERS, {c: blank(c) for c in ("order_date", "order_status")}),
            check_rows(
                "range",
                "gold_daily_orders_summary",
                DAILY_ORDERS,
                {"total_orders > 0": "total_orders <= 0", "avg_delivery_days >= 0": "avg_delivery_days < 0"},
            ),
        ]
    ),
    "raw_quality": " UNION ALL ".join(
        [
            unique_rows("lineitem", "lineitem", ["l_orderkey", "l_linenumber"]),
            check_rows("not_null", "trips", TYPED_TRIPS, {c: blank(c) for c in ("PULocationID", "trip_distance", "tolls_amount")}),
            check_rows(
                "range",
                "trips",
                TYPED_TRIPS,
                {"fare_amount >= 0": "fare_amount < 0", "trip_distance > 10": "trip_distance <= 10"},
            ),
        ]
    ),
    "repeated_lines": """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
      GROUP BY ALL HAVING count(*) > 1""",
    "reconcile_layers": f"""SELECT d AS detail_rows, t AS mart_total, d - t AS difference, w AS rows_without_day, d = t AS passed
      FROM (SELECT count(*) AS d, count(*) - count(order_purchase_timestamp) AS w FROM {SILVER_ORDERS} s) a,
      (SELECT CAST(sum(total_orders) AS BIGINT) AS t FROM {DAILY_ORDERS} m) b""",
    "row_balance": f"""SELECT n AS raw_rows, b AS bad_rows, v - u AS duplicate_rows, k AS kept_rows, n - b - (v - u) = k AS passed
      FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {BAD}) AS b FROM {raw_sql("orders")} r) a,
      (SELECT count(*) AS v, count(DISTINCT trim(order_id)) AS u FROM {VALID_ORDERS} w) c,
      (SELECT count(*) AS k FROM {SILVER_ORDERS} s) d""",
    "lost_rows": """SELECT *, 'lost' AS side FROM events WHERE event_id % 997 = 3 OR event_id % 101 = 5
      UNION ALL SELECT * REPLACE (value + 1 AS value), 'added' FROM events WHERE event_id % 101 = 5 AND event_id % 997 <> 3
      UNION ALL SELECT *, 'added' FROM events WHERE event_id % 991 = 7""",
    "compaction_files": """SELECT CAST(4 AS INTEGER) AS files_before, CAST(2 AS BIGINT) AS files_after, CAST(1 AS BIGINT) AS untouched,
      count(*) FILTER (WHERE event_id % 20 IN (1, 2, 3)) AS rows_rewritten,
      CAST(count(*) + count(*) FILTER (WHERE event_id % 20 IN (1, 2, 3)) AS INTEGER) AS row_count FROM events""",
    "clustering_depths": """SELECT c AS "column", CAST(16 AS BIGINT) AS files_before, CAST(16 AS BIGINT) AS files_after,
      true AS within_bound, true AS less FROM (VALUES ('user_id'), ('ts')) v(c)""",
    "zorder_roundtrip": f"SELECT * FROM {DAILY_ZONES} m",
    "orders_zorder_roundtrip": f"SELECT * FROM {SILVER_ORDERS} s",
    "compact_roundtrip": "SELECT *, CAST(day(ts) AS INTEGER) AS day FROM events",
    "partition_overwrite": "SELECT event_id, ts, user_id, event_type, value * 2 AS value, props, CAST(day(ts) AS INTEGER) AS day FROM events",
    "serving_rows_orders": _SERVING_ORDERS,
    "serving_rows_zones": _SERVING_ZONES,
    "serving_constraints": " UNION ALL ".join(
        f"""SELECT '{c} not null' AS "constraint", count(*) - count({c}) AS violations FROM ({_SERVING_ZONES}) z"""
        for c in _ZONE_REQUIRED
    )
    + f""" UNION ALL SELECT '_gold_calculated_at not null', CAST(0 AS BIGINT) UNION ALL
      SELECT 'primary key (pickup_date, pulocationid, payment_type)', count(*) FROM (SELECT 1 FROM ({_SERVING_ZONES}) z
      GROUP BY pickup_date, pulocationid, payment_type HAVING count(*) > 1) k"""
    + "".join(
        f""" UNION ALL SELECT '{c} fits {kind}', count(*) FILTER (WHERE {_too_wide(c, kind)}) FROM {DAILY_ZONES} m"""
        for c, kind in SERVING_TABLES["gold_daily_zone_metrics"].columns.items()
    ),
    "publish_dry_run": f"""SELECT 'gold_daily_orders_summary' AS "table", count(*) AS row_count,
      '{_DRY_COLUMNS}' AS "columns", '{_DRY_STATEMENT}' AS statement FROM {DAILY_ORDERS} m""",
    "orders_csv_to_gold": f"""SELECT *, (SELECT count(*) FROM {raw_sql("orders")} r WHERE {BAD}) AS quarantined_rows FROM {DAILY_ORDERS} m""",
    "json_documents_split": f"""SELECT 'row' AS kind, {DOCUMENT} AS doc, event_id, user_id, event_type, props, CAST(NULL AS BOOLEAN) AS has_text
      FROM events WHERE day(ts) % {CUT_DAYS} <> 3
      UNION ALL SELECT DISTINCT 'broken', {DOCUMENT}, NULL, NULL, NULL, NULL, true FROM events WHERE day(ts) % {CUT_DAYS} = 3""",
    "dated_landing": f"""SELECT status, count(*) AS files, day FROM (
        SELECT 1 AS day, 'new' AS status FROM ({EVENT_DAYS.format(events="events")}) d WHERE fate <> 'unexpected'
        UNION ALL SELECT 2, CASE WHEN fate IN ('altered', 'swapped') THEN 'changed' WHEN fate = 'unexpected' THEN 'new' ELSE 'unchanged' END
          FROM ({EVENT_DAYS.format(events="events")}) d WHERE fate <> 'missing'
        UNION ALL SELECT 3, 'unchanged' FROM ({EVENT_DAYS.format(events="events")}) d WHERE fate <> 'missing') l GROUP BY day, status""",
    "trips_csv_to_gold": f"SELECT * FROM {DAILY_ZONES} m",
    "run_summary": f"""SELECT 'silver' AS stage, 'ecommerce quarantined' AS item, count(*) AS row_count, 'ok' AS status
      FROM {raw_sql("orders")} r WHERE {BAD}
      UNION ALL SELECT 'silver', 'ecommerce silver', count(*), 'ok' FROM {SILVER_ORDERS} s
      UNION ALL SELECT 'silver', 'nyctaxi quarantined', count(*), 'ok' FROM {raw_sql("lineitem")} r
        WHERE _corrupt_record IS NOT NULL OR VendorID IS NULL OR trim(VendorID) = ''
      UNION ALL SELECT 'silver', 'nyctaxi silver', count(*), 'ok' FROM {DISTINCT_TRIPS} t
      UNION ALL SELECT 'gold', 'gold_daily_orders_summary', count(*), 'ok' FROM {DAILY_ORDERS} m
      UNION ALL SELECT 'gold', 'gold_daily_zone_metrics', count(*), 'ok' FROM {DAILY_ZONES} z
      UNION ALL SELECT 'serving', 'gold_daily_orders_summary', NULL, 'skipped'
      UNION ALL SELECT 'serving', 'gold_daily_zone_metrics', NULL, 'skipped'""",
    "sales_json_to_gold": f"SELECT * FROM {customer_value(_JSON_SALES)} c",
}
