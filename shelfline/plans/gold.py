"""Gold datasets.

Orders are reduced to one row per product or customer before they meet the product or customer
table. Both sides of those joins then have unique keys, so the join does not fan out, moves far
fewer rows, and has no hot key. The distinct order counts are planned by Spark over
(group, order id), which spreads a hot group over many tasks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators import money
from shelfline.operators.dates import today
from shelfline.schemas import ORDER_STATUSES


def gold_revenue_daily(orders: DataFrame) -> DataFrame:
    """Revenue by day and country over every order of a known status, returned ones included."""
    status = F.col("status")
    return (
        orders.filter(status.isin(*ORDER_STATUSES))
        .groupBy(F.to_date("order_date").alias("order_day"), "ship_country")
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            money.rounded_total("total_amount").alias("total_revenue"),
            money.rounded_mean("total_amount").alias("avg_order_value"),
            F.count_if(status == "returned").alias("returns"),
            F.count_if(status == "cancelled").alias("cancellations"),
        )
    )


def product_orders(orders: DataFrame) -> DataFrame:
    """What each order holds of each product, in a form that is added up again when more rows come."""
    return orders.groupBy("product_id", "order_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").cast("long").alias("units"),
        money.exact_total("total_amount").alias("revenue"),
        F.count_if(F.col("status") == "returned").alias("returned"),
    )


def product_lines(orders: DataFrame) -> DataFrame:
    """Order lines as parts of :func:`product_orders`, which are then added up once with those of before."""
    return orders.select(
        "product_id",
        "order_id",
        F.lit(1).cast("long").alias("lines"),
        F.col("quantity").cast("long").alias("units"),
        money.exact("total_amount").alias("revenue"),
        _one_if(F.col("status") == "returned").alias("returned"),
    )


def _one_if(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("long")


def added_product_orders(parts: DataFrame) -> DataFrame:
    """Parts of :func:`product_orders` as one."""
    return parts.groupBy("product_id", "order_id").agg(
        *[F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in ("lines", "units", "revenue", "returned")]
    )


def product_totals(by_order: DataFrame) -> DataFrame:
    """Totals of each product over its distinct orders."""
    return by_order.groupBy("product_id").agg(
        F.count("order_id").alias("orders_count"),
        F.sum("units").alias("units_sold"),
        F.round(F.sum("revenue"), 2).cast("double").alias("total_revenue"),
        money.percent(F.sum("returned"), F.sum("lines"), 2).alias("return_rate_pct"),
    )


def described_products(sold: DataFrame, products: DataFrame) -> DataFrame:
    described = products.select("product_id", "product_name", "category", "brand", "price", "margin_pct")
    return described.join(sold, "product_id")


def gold_top_products(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Units, revenue and return rate of each product that was ordered."""
    sold = orders.groupBy("product_id").agg(
        F.count_distinct("order_id").alias("orders_count"),
        F.sum("quantity").alias("units_sold"),
        money.rounded_total("total_amount").alias("total_revenue"),
        money.percent(F.count_if(F.col("status") == "returned"), F.count(F.lit(1)), 2).alias("return_rate_pct"),
    )
    return described_products(sold, products)


SESSION_KEYS = ["session_id", "customer_id"]
SESSION_MONTH = "session_month"


def session_parts(clicks: DataFrame) -> DataFrame:
    """What is known of each session, in a form that is merged again when more clicks come."""

    def seen(kind: str) -> Column:
        return F.coalesce(F.bool_or(F.col("event_type") == kind), F.lit(False))

    return clicks.groupBy(*SESSION_KEYS).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.min("event_ts").alias("session_start"),
        F.max("event_ts").alias("session_end"),
        seen("add_to_cart").alias("carted"),
        seen("purchase").alias("bought"),
    )


def session_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks as parts of :func:`session_parts`, which are then merged once with those of before."""

    def seen(kind: str) -> Column:
        return F.coalesce(F.col("event_type") == kind, F.lit(False))

    return clicks.select(
        *SESSION_KEYS,
        F.lit(1).cast("long").alias("event_count"),
        F.col("event_ts").alias("session_start"),
        F.col("event_ts").alias("session_end"),
        seen("add_to_cart").alias("carted"),
        seen("purchase").alias("bought"),
    )


def merged_sessions(parts: DataFrame) -> DataFrame:
    """Parts of :func:`session_parts` as one."""
    return parts.groupBy(*SESSION_KEYS).agg(
        F.sum("event_count").alias("event_count"),
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        F.bool_or("carted").alias("carted"),
        F.bool_or("bought").alias("bought"),
    )


def with_session_month(sessions: DataFrame) -> DataFrame:
    """The column that stored sessions are partitioned by: the month a session starts in, whatever month it ends in."""
    return sessions.withColumn(SESSION_MONTH, F.trunc("session_start", "month"))


def session_view(sessions: DataFrame) -> DataFrame:
    """One row per session of a customer; abandoned means a filled cart and no purchase."""
    minutes = (F.unix_timestamp("session_end") - F.unix_timestamp("session_start")) / F.lit(60.0)
    return sessions.select(
        *SESSION_KEYS,
        "event_count",
        "session_start",
        "session_end",
        F.round(minutes, 1).cast("double").alias("duration_mins"),
        (F.col("carted") & ~F.col("bought")).alias("abandoned"),
        *[c for c in sessions.columns if c == SESSION_MONTH],
    )


def gold_cart_abandonment(clicks: DataFrame) -> DataFrame:
    """One row per session of a customer; abandoned means a filled cart and no purchase."""
    return session_view(session_parts(clicks))


def gold_customer_ltv(customers: DataFrame, orders: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Value of each customer from completed orders (an order without status counts as well).

    A customer without any order stays, with no value; one whose orders are all of another status
    is left out.
    """
    counts = _counts()
    bought = orders.groupBy("customer_id").agg(
        F.count_if(counts).alias("_counted"),
        F.count_distinct(F.when(counts, F.col("order_id"))).alias("_orders"),
        money.rounded_total(F.when(counts, F.col("total_amount"))).alias("lifetime_value"),
        money.rounded_mean(F.when(counts, F.col("total_amount"))).alias("avg_order_value"),
        F.max(F.when(counts, F.col("order_date"))).alias("last_order_date"),
    )
    return valued_customers(customers, bought, as_of)


def _counts() -> Column:
    return (F.col("status") == "completed") | F.col("status").isNull()


def customer_orders(orders: DataFrame) -> DataFrame:
    """What each order is worth to each customer, in a form that is added up again when more rows come."""
    counted = F.when(_counts(), F.col("total_amount"))
    return orders.groupBy("customer_id", "order_id").agg(
        F.count_if(_counts()).alias("counted"),
        F.count(counted).alias("amounts"),
        money.exact_total(counted).alias("value"),
        F.max(F.when(_counts(), F.col("order_date"))).alias("last_date"),
    )


def customer_lines(orders: DataFrame) -> DataFrame:
    """Order lines as parts of :func:`customer_orders`, which are then added up once with those of before."""
    counted = F.when(_counts(), F.col("total_amount"))
    return orders.select(
        "customer_id",
        "order_id",
        _one_if(_counts()).alias("counted"),
        _one_if(counted.isNotNull()).alias("amounts"),
        money.exact(counted).alias("value"),
        F.when(_counts(), F.col("order_date")).alias("last_date"),
    )


def added_customer_orders(parts: DataFrame) -> DataFrame:
    """Parts of :func:`customer_orders` as one."""
    sums = [F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in ("counted", "amounts", "value")]
    return parts.groupBy("customer_id", "order_id").agg(*sums, F.max("last_date").alias("last_date"))


def customer_totals(by_order: DataFrame) -> DataFrame:
    """Totals of each customer over the distinct orders that count."""
    whole = F.sum("value")
    return by_order.groupBy("customer_id").agg(
        F.sum("counted").alias("_counted"),
        F.count(F.when(F.col("counted") > 0, F.col("order_id"))).alias("_orders"),
        F.round(whole, 2).cast("double").alias("lifetime_value"),
        money.rounded_share(whole, F.nullif(F.sum("amounts"), F.lit(0))).alias("avg_order_value"),
        F.max("last_date").alias("last_order_date"),
    )


def valued_customers(customers: DataFrame, bought: DataFrame, as_of: dt.date | None) -> DataFrame:
    return (
        customers.select("customer_id", "segment", "country", "is_active")
        .join(bought, "customer_id", "left")
        .filter(F.col("_counted").isNull() | (F.col("_counted") > 0))
        .select(
            "customer_id",
            "segment",
            "country",
            "is_active",
            F.coalesce(F.col("_orders"), F.lit(0)).alias("total_orders"),
            "lifetime_value",
            "avg_order_value",
            "last_order_date",
            F.datediff(today(as_of), F.to_date("last_order_date")).alias("days_since_last_order"),
        )
    )
