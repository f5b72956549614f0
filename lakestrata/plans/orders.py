"""E-commerce orders delivered as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.audit import stamp
from ..functions.calendar import month_of, year_of
from ..functions.casts import clean_label, clean_text, to_time
from ..operators.dedup import latest_by
from ..sources.raw import SOURCE

# Raw columns, partition columns, default partition.
TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
RAW_COLUMNS = ("order_id", "customer_id", "order_status", *TIMES)
RAW_SCHEMA = ", ".join(f"{c} STRING" for c in RAW_COLUMNS)
KEY = "order_id"
PARTITIONS = ("order_year", "order_month")
NO_YEAR, NO_MONTH = 1970, 1


def typed(valid: DataFrame) -> DataFrame:
    """Trimmed text, lower-case status, UTC timestamps (NULL where unreadable), partition columns."""
    columns = {
        "order_id": clean_text("order_id"),
        "customer_id": clean_text("customer_id"),
        "order_status": clean_label("order_status"),
    }
    columns |= {c: to_time(c) for c in TIMES}
    return valid.withColumns(columns).withColumns(
        {
            "order_year": year_of("order_purchase_timestamp", NO_YEAR),
            "order_month": month_of("order_purchase_timestamp", NO_MONTH),
        }
    )


def clean(valid: DataFrame) -> DataFrame:
    """Typed orders, the latest purchase per order id; the later file name decides between equals."""
    latest = latest_by(typed(valid), [KEY], "order_purchase_timestamp", SOURCE)
    return stamp(latest, "_ingested_at").select(
        *[c for c in latest.columns if c not in (*PARTITIONS, SOURCE)],
        *[F.col(c) for c in (SOURCE, "_ingested_at", *PARTITIONS)],
    )
