"""First-generation orders delivered as JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.audit import stamp
from ..functions.casts import clean_label, to_double, to_text, to_time
from ..operators.dedup import latest_by
from ..operators.split import require_key

KEY = "order_id"


def typed(bronze: DataFrame) -> DataFrame:
    """Orders with a key, text ids, amount as double, lower-case status, ``order_timestamp`` from ``order_date``."""
    return require_key(bronze, KEY).withColumns(
        {
            "order_id": to_text("order_id"),
            "customer_id": to_text("customer_id"),
            "amount": to_double("amount"),
            "status": clean_label("status"),
            "order_timestamp": to_time("order_date"),
        }
    )


def clean(bronze: DataFrame) -> DataFrame:
    """Typed orders, the last ingested row per order id."""
    return stamp(latest_by(typed(bronze), [KEY], "_ingested_at"), "_silver_processed_at")
