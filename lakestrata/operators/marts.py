"""Daily and lifetime rollups.

Every aggregate combines before the shuffle. The one distinct count per mart makes Spark group by
(key, customer) first, so a day or status that holds most of the table is spread over tasks by
customer. Marts come unsorted: the writers lay rows out by partition and cluster key, and the
report views sort what they show.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.audit import stamp
from ..functions.calendar import day_of, days_between, month_of, year_of
from ..functions.exact import avg_rounded, sum_rounded
from .contracts import CUSTOMER_VALUE, DAILY_ORDERS, DAILY_SALES, DAILY_ZONES, conform

CALCULATED = "_gold_calculated_at"


def _count_if(condition):
    return F.sum(F.when(condition, 1).otherwise(0))


def _report_period(df: DataFrame, day: str) -> DataFrame:
    return df.withColumns({"report_year": year_of(day), "report_month": month_of(day)})


def daily_orders(
    orders: DataFrame,
    *,
    order_id: str = "order_id",
    customer: str = "customer_id",
    status: str = "order_status",
    purchased: str = "order_purchase_timestamp",
    delivered_on: str = "order_delivered_customer_date",
    delivered: str = "delivered",
    cancelled: str = "canceled",
) -> DataFrame:
    """Orders per day and status: volume, customers, mean delivery days of delivered orders.

    Orders without a purchase day are left out before the shuffle; a NULL status is a group.
    """
    is_delivered = F.col("order_status") == delivered
    daily = (
        orders.where(F.col(purchased).isNotNull())
        .select(
            day_of(purchased).alias("order_date"),
            F.col(status).alias("order_status"),
            F.col(order_id).alias("_order"),
            F.col(customer).alias("_customer"),
            days_between(purchased, delivered_on).alias("_lead"),
        )
        .groupBy("order_date", "order_status")
        .agg(
            F.count("_order").alias("total_orders"),
            F.count_distinct("_customer").alias("unique_customers"),
            avg_rounded(F.when(is_delivered, F.col("_lead"))).alias("avg_delivery_days"),
            _count_if(is_delivered).alias("delivered_orders"),
            _count_if(F.col("order_status") == cancelled).alias("cancelled_orders"),
        )
    )
    return conform(stamp(_report_period(daily, "order_date"), CALCULATED), DAILY_ORDERS)


def daily_zones(
    trips: DataFrame,
    *,
    picked_up: str = "pickup_datetime",
    zone: str = "PULocationID",
    payment: str = "payment_type",
    total: str = "total_amount",
    distance: str = "trip_distance",
    fare: str = "fare_amount",
    tip: str = "tip_amount",
) -> DataFrame:
    """Trips per day, pickup zone and payment type; trips without a day or zone are left out."""
    daily = (
        trips.where(F.col(picked_up).isNotNull() & F.col(zone).isNotNull())
        .groupBy(
            day_of(picked_up).alias("pickup_date"),
            F.col(zone).alias("PULocationID"),
            F.col(payment).alias("payment_type"),
        )
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            sum_rounded(total).alias("total_revenue"),
            avg_rounded(distance).alias("avg_trip_distance"),
            avg_rounded(fare).alias("avg_fare_per_trip"),
            avg_rounded(tip).alias("avg_tip_amount"),
        )
    )
    return conform(stamp(_report_period(daily, "pickup_date"), CALCULATED), DAILY_ZONES)


def _completed_amount(status: str, amount: str, completed: str, otherwise):
    return F.when(F.col(status) == completed, F.col(amount)).otherwise(otherwise)


def daily_sales(
    orders: DataFrame,
    *,
    order_id: str = "order_id",
    customer: str = "customer_id",
    amount: str = "amount",
    status: str = "status",
    ordered: str = "order_timestamp",
    completed: str = "completed",
    cancelled: str = "cancelled",
) -> DataFrame:
    """Sales per day; orders without a day form a group of their own."""
    daily = orders.groupBy(day_of(ordered).alias("order_day")).agg(
        F.count(order_id).alias("total_orders"),
        F.count_distinct(customer).alias("unique_customers"),
        sum_rounded(_completed_amount(status, amount, completed, 0.0)).alias("total_completed_revenue"),
        _count_if(F.col(status) == completed).alias("completed_orders"),
        _count_if(F.col(status) == cancelled).alias("cancelled_orders"),
    )
    return conform(stamp(daily, CALCULATED), DAILY_SALES)


def customer_value(
    orders: DataFrame,
    *,
    order_id: str = "order_id",
    customer: str = "customer_id",
    amount: str = "amount",
    status: str = "status",
    ordered: str = "order_timestamp",
    completed: str = "completed",
) -> DataFrame:
    """Lifetime orders, completed spend and mean completed order per customer."""
    lifetime = orders.groupBy(F.col(customer).alias("customer_id")).agg(
        F.count(order_id).alias("total_orders"),
        sum_rounded(_completed_amount(status, amount, completed, 0.0)).alias("total_lifetime_spend"),
        avg_rounded(_completed_amount(status, amount, completed, None)).alias("avg_order_value"),
        F.max(ordered).alias("latest_order_timestamp"),
    )
    return conform(stamp(lifetime, CALCULATED), CUSTOMER_VALUE)


def orders_by_month_status(
    orders: DataFrame,
    *,
    order_id: str = "order_id",
    year: str = "order_year",
    month: str = "order_month",
    status: str = "order_status",
) -> DataFrame:
    """Order count per year, month and status, latest month first."""
    return (
        orders.groupBy(F.col(year).alias("order_year"), F.col(month).alias("order_month"), F.col(status).alias("order_status"))
        .agg(F.count(order_id).alias("order_count"))
        .orderBy(F.desc("order_year"), F.desc("order_month"))
    )
