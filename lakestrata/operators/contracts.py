"""Column contracts of the marts: names, order, types, keys and required columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column names and types of the silver tables and gold marts.
SILVER_ORDERS = {
    "order_id": "string",
    "customer_id": "string",
    "order_status": "string",
    "order_purchase_timestamp": "timestamp",
    "order_year": "int",
    "order_month": "int",
    "_ingested_at": "timestamp",
}

DAILY_ORDERS = {
    "order_date": "date",
    "order_status": "string",
    "total_orders": "bigint",
    "unique_customers": "bigint",
    "avg_delivery_days": "double",
    "delivered_orders": "bigint",
    "cancelled_orders": "bigint",
    "report_year": "int",
    "report_month": "int",
    "_gold_calculated_at": "timestamp",
}

DAILY_ZONES = {
    "pickup_date": "date",
    "PULocationID": "int",
    "payment_type": "int",
    "total_trips": "bigint",
    "total_revenue": "double",
    "avg_trip_distance": "double",
    "avg_fare_per_trip": "double",
    "avg_tip_amount": "double",
    "report_year": "int",
    "report_month": "int",
    "_gold_calculated_at": "timestamp",
}

DAILY_SALES = {
    "order_day": "date",
    "total_orders": "bigint",
    "unique_customers": "bigint",
    "total_completed_revenue": "double",
    "completed_orders": "bigint",
    "cancelled_orders": "bigint",
    "_gold_calculated_at": "timestamp",
}

CUSTOMER_VALUE = {
    "customer_id": "string",
    "total_orders": "bigint",
    "total_lifetime_spend": "double",
    "avg_order_value": "double",
    "latest_order_timestamp": "timestamp",
    "_gold_calculated_at": "timestamp",
}


def conform(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Exactly the contract's columns, in its order, cast to its types."""
    return df.select([F.col(name).cast(kind).alias(name) for name, kind in contract.items()])


@dataclass(frozen=True)
class ServingTable:
    """A relational table: key, SQL column types and NOT NULL columns."""

    name: str
    key: tuple[str, ...]
    columns: Mapping[str, str]
    required: tuple[str, ...]
    loaded_at: str = "_postgres_loaded_at"

    def spark_type(self, column: str) -> str:
        kind = self.columns[column]
        if kind.startswith("VARCHAR"):
            return "string"
        return {"TIMESTAMPTZ": "timestamp"}.get(kind, kind.lower().replace("numeric", "decimal"))

    def max_lengths(self) -> dict[str, int]:
        return {c: int(k[8:-1]) for c, k in self.columns.items() if k.startswith("VARCHAR(")}

    def default(self, column: str) -> str | None:
        """What a required column outside the key takes when a row does not name it: measures 0, times the present."""
        if column not in self.required or column in self.key:
            return None
        kind = self.columns[column]
        return "0" if kind == "BIGINT" or kind.startswith("NUMERIC") else "CURRENT_TIMESTAMP" if kind == "TIMESTAMPTZ" else None


# Serving tables with keys, SQL types and NOT NULL columns.
SERVING_TABLES = {
    t.name: t
    for t in (
        ServingTable(
            "gold_daily_orders_summary",
            ("order_date", "order_status"),
            {
                "order_date": "DATE",
                "order_status": "VARCHAR(32)",
                "total_orders": "BIGINT",
                "unique_customers": "BIGINT",
                "avg_delivery_days": "NUMERIC(8,2)",
                "delivered_orders": "BIGINT",
                "cancelled_orders": "BIGINT",
                "report_year": "INT",
                "report_month": "INT",
                "_gold_calculated_at": "TIMESTAMPTZ",
            },
            (
                "order_date",
                "order_status",
                "total_orders",
                "unique_customers",
                "delivered_orders",
                "cancelled_orders",
                "report_year",
                "report_month",
                "_gold_calculated_at",
            ),
        ),
        ServingTable(
            "gold_daily_zone_metrics",
            ("pickup_date", "pulocationid", "payment_type"),
            {
                "pickup_date": "DATE",
                "pulocationid": "INT",
                "payment_type": "INT",
                "total_trips": "BIGINT",
                "total_revenue": "NUMERIC(14,2)",
                "avg_trip_distance": "NUMERIC(8,2)",
                "avg_fare_per_trip": "NUMERIC(10,2)",
                "avg_tip_amount": "NUMERIC(10,2)",
                "report_year": "INT",
                "report_month": "INT",
                "_gold_calculated_at": "TIMESTAMPTZ",
            },
            (
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
                "_gold_calculated_at",
            ),
        ),
        ServingTable(
            "gold_customer_metrics",
            ("customer_id",),
            {
                "customer_id": "VARCHAR(64)",
                "total_orders": "BIGINT",
                "total_lifetime_spend": "NUMERIC(14,2)",
                "avg_order_value": "NUMERIC(14,2)",
                "latest_order_timestamp": "TIMESTAMPTZ",
                "_gold_calculated_at": "TIMESTAMPTZ",
            },
            ("customer_id", "total_orders", "total_lifetime_spend", "_gold_calculated_at"),
        ),
        ServingTable(
            "gold_daily_sales",
            ("order_day",),
            {
                "order_day": "DATE",
                "total_orders": "BIGINT",
                "unique_customers": "BIGINT",
                "total_completed_revenue": "NUMERIC(14,2)",
                "completed_orders": "BIGINT",
                "cancelled_orders": "BIGINT",
                "_gold_calculated_at": "TIMESTAMPTZ",
            },
            (
                "order_day",
                "total_orders",
                "unique_customers",
                "total_completed_revenue",
                "completed_orders",
                "cancelled_orders",
            ),
        ),
    )
}
