"""Taxi trips delivered as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.audit import stamp
from ..functions.calendar import month_of, year_of
from ..functions.casts import clean_text, to_double, to_int, to_time
from ..operators.dedup import distinct_by
from ..operators.split import keep_in_range

# Raw columns in file order, target types, lower bounds, identity of a trip.
RAW_COLUMNS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
)
RAW_SCHEMA = ", ".join(f"{c} STRING" for c in RAW_COLUMNS)
INTEGERS = ("VendorID", "passenger_count", "RatecodeID", "PULocationID", "DOLocationID", "payment_type")
DOUBLES = (
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
)
LOWER_BOUNDS = {"fare_amount": 0.0, "total_amount": 0.0, "trip_distance": 0.0}
SET_COLUMNS = ("pickup_datetime",)
IDENTITY = ("VendorID", "pickup_datetime", "PULocationID")
KEY = "VendorID"
PARTITIONS = ("pickup_year", "pickup_month")


def typed(valid: DataFrame) -> DataFrame:
    """Numbers and times in place of text; the raw pickup and dropoff text stays beside the times."""
    columns = {c: to_int(c) for c in INTEGERS} | {c: to_double(c) for c in DOUBLES}
    columns["store_and_fwd_flag"] = clean_text("store_and_fwd_flag")
    columns["pickup_datetime"] = to_time("tpep_pickup_datetime")
    columns["dropoff_datetime"] = to_time("tpep_dropoff_datetime")
    return valid.withColumns(columns)


def in_bounds(trips: DataFrame) -> DataFrame:
    return keep_in_range(trips, LOWER_BOUNDS, SET_COLUMNS)


def clean(valid: DataFrame) -> DataFrame:
    """Typed trips without negative or missing measures, one per vendor, pickup time and zone."""
    kept = distinct_by(in_bounds(typed(valid)), IDENTITY)
    dated = kept.withColumns({"pickup_year": year_of("pickup_datetime"), "pickup_month": month_of("pickup_datetime")})
    return stamp(dated, "_ingested_at")
