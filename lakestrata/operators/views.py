"""Reporting views over the marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import as_column
from ..functions.exact import avg_rounded, round_half_up, sum_rounded
from ..functions.labels import first_nonzero
from ..sources.tables import since


def monthly_trends(daily_orders: DataFrame) -> DataFrame:
    """Monthly order counts; delivery time is the plain mean of the daily means, as published."""
    return (
        daily_orders.groupBy("report_year", "report_month")
        .agg(
            F.sum("total_orders").alias("monthly_orders"),
            F.sum("delivered_orders").alias("monthly_delivered"),
            F.sum("cancelled_orders").alias("monthly_cancelled"),
            avg_rounded("avg_delivery_days").alias("avg_delivery_time_days"),
        )
        .orderBy(F.desc("report_year"), F.desc("report_month"))
    )


def zone_revenue(daily_zones: DataFrame) -> DataFrame:
    """Trips, revenue and mean daily fare per pickup zone, highest revenue first."""
    return (
        daily_zones.groupBy(F.col("PULocationID").alias("pulocationid"))
        .agg(
            F.sum("total_trips").alias("total_trips"),
            sum_rounded("total_revenue").alias("total_zone_revenue"),
            avg_rounded("avg_fare_per_trip").alias("avg_zone_fare"),
        )
        .orderBy(F.desc_nulls_first("total_zone_revenue"), "pulocationid")
    )


def top_zones(daily_zones: DataFrame, limit: int = 10) -> DataFrame:
    """The ``limit`` pickup zones with the highest revenue; equal revenue by zone number."""
    return (
        daily_zones.groupBy(F.col("PULocationID").alias("pickup_zone"))
        .agg(
            F.sum("total_trips").alias("total_trips"),
            sum_rounded("total_revenue").alias("total_revenue"),
            avg_rounded("avg_fare_per_trip").alias("avg_fare"),
            avg_rounded("avg_tip_amount").alias("avg_tip"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), "pickup_zone")
        .limit(limit)
    )


def label_totals(mart: DataFrame, label: Column | str, measure: str) -> DataFrame:
    """``label, total``: the measure added up per label."""
    return mart.groupBy(as_column(label).alias("label")).agg(F.sum(measure).alias("total"))


def delivery_report(daily_orders: DataFrame, first_day: dt.date) -> DataFrame:
    """Daily delivery figures from ``first_day`` on, latest day and largest volume first."""
    return (
        since(daily_orders, "order_date", first_day, "report_year", "report_month")
        .select(
            "order_date",
            "order_status",
            "total_orders",
            "unique_customers",
            round_half_up("avg_delivery_days", 1).alias("avg_delivery_days"),
            "delivered_orders",
        )
        .orderBy(F.desc("order_date"), F.desc("total_orders"))
    )


def high_value_customers(customers: DataFrame, above: float = 200.0) -> DataFrame:
    """Customers whose lifetime spend is more than ``above``, highest first."""
    return (
        customers.where(F.col("total_lifetime_spend") > above)
        .select("customer_id", "total_orders", "total_lifetime_spend", "avg_order_value", "latest_order_timestamp")
        .orderBy(F.desc("total_lifetime_spend"))
    )


def search(df: DataFrame, text: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows in which the text of any column holds ``text``, upper and lower case alike. Empty text finds all."""
    if not text:
        return df
    wanted = text.lower()
    hits = [
        F.coalesce(F.lower(F.col(c).cast("string")).contains(wanted), F.lit(False)) for c in (columns or df.columns)
    ]
    return df.where(reduce(or_, hits))


def sort_by(df: DataFrame, column: str, descending: bool = False, then: Sequence[str] = ()) -> DataFrame:
    """All rows by any column in either direction, ties by ``then``."""
    first = F.desc(column) if descending else F.asc(column)
    return df.orderBy(first, *then)


def chart_points(mart: DataFrame, keys: Sequence[str], day: str, volumes: Sequence[str], means: Sequence[str], limit: int = 15) -> DataFrame:
    """First ``limit`` rows in key order as ``label, volume, mean``; of several columns the first that is not 0."""
    return (
        mart.orderBy(*keys)
        .limit(limit)
        .select(
            F.coalesce(F.col(day).cast("string"), F.lit("N/A")).alias("label"),
            first_nonzero(*volumes).alias("volume"),
            first_nonzero(*means).alias("mean"),
        )
    )


def totals(df: DataFrame, sums: Mapping[str, str] | None = None, distinct: Mapping[str, str] | None = None) -> DataFrame:
    """One row: row count, sums and exact distinct counts of columns (``{output: column}``)."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.sum(c).alias(name) for name, c in (sums or {}).items()],
        *[F.count_distinct(c).alias(name) for name, c in (distinct or {}).items()],
    )
