"""Dashboard datasets and certified answers over the gold tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.operators import money
from shelfline.operators.dates import in_month_of


def revenue_trend(daily: DataFrame) -> DataFrame:
    """Revenue per day; the order value is the plain mean of the countries' means."""
    return (
        daily.groupBy("order_day")
        .agg(
            money.total("total_revenue").alias("revenue"),
            F.sum("order_count").alias("orders"),
            money.mean("avg_order_value").alias("avg_order_value"),
        )
        .orderBy("order_day")
    )


def revenue_by_country(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy(F.col("ship_country").alias("country"))
        .agg(money.total("total_revenue").alias("total_revenue"), F.sum("order_count").alias("total_orders"))
        .orderBy(F.desc("total_revenue"))
    )


PRODUCT_REPORT = (
    "product_name",
    "category",
    "brand",
    "units_sold",
    "total_revenue",
    "margin_pct",
    "return_rate_pct",
)


def top_products(products: DataFrame, n: int = 10) -> DataFrame:
    """Best sellers by revenue; equal revenues are ordered by product key."""
    return products.orderBy(F.desc("total_revenue"), "product_id").limit(n).select(*PRODUCT_REPORT)


def sessions_per_day(sessions: DataFrame) -> DataFrame:
    return (
        sessions.groupBy(F.to_date("session_start").alias("day"))
        .agg(F.count(F.lit(1)).alias("total_sessions"))
        .orderBy("day")
    )


def ltv_by_segment_country(ltv: DataFrame) -> DataFrame:
    return (
        ltv.groupBy("segment", "country")
        .agg(
            F.count("customer_id").alias("customer_count"),
            money.mean("lifetime_value").alias("avg_ltv"),
            F.avg("total_orders").alias("avg_orders"),
        )
        .orderBy(F.desc("avg_ltv"))
    )


def bi_counters(daily: DataFrame) -> DataFrame:
    """The three dashboard counters, totals over the daily trend.

    The order value is a mean of daily means, so it differs from revenue divided by orders.
    """
    return revenue_trend(daily).agg(
        money.total("revenue").alias("total_revenue"),
        F.sum("orders").alias("total_orders"),
        money.mean("avg_order_value").alias("avg_order_value"),
    )


def month_revenue(daily: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return daily.filter(in_month_of("order_day", as_of)).agg(
        money.rounded_total("total_revenue").alias("current_month_revenue"),
        F.sum("order_count").alias("current_month_orders"),
    )


def weekly_revenue(daily: DataFrame) -> DataFrame:
    """Revenue per week; weeks start on Monday."""
    return daily.groupBy(F.date_trunc("week", "order_day").alias("week_start")).agg(
        money.total("total_revenue").alias("weekly_revenue")
    )


def wow_revenue(daily: DataFrame, weeks: int = 8) -> DataFrame:
    """Change against the week before that has any revenue, for the latest weeks.

    The window has no partition: it runs over one row per week, however large the orders are.
    """
    series = weekly_revenue(daily)
    before = F.lag("weekly_revenue").over(Window.orderBy("week_start"))
    change = (F.col("weekly_revenue") - F.col("prev_week_revenue")) / F.nullif("prev_week_revenue", F.lit(0))
    return (
        series.withColumn("prev_week_revenue", before)
        .withColumn("wow_change_pct", F.round(change * 100, 1))
        .orderBy(F.desc("week_start"))
        .limit(weeks)
    )


def category_summary(products: DataFrame) -> DataFrame:
    return (
        products.groupBy("category")
        .agg(
            F.count("product_id").alias("product_count"),
            F.sum("units_sold").alias("total_units"),
            money.rounded_total("total_revenue").alias("total_revenue"),
            money.rounded_mean("margin_pct", 1).alias("avg_margin_pct"),
            money.rounded_mean("return_rate_pct", 1).alias("avg_return_rate"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def moving_average(daily: DataFrame, days: int = 7) -> DataFrame:
    """Daily revenue with the mean of the last ``days`` days that have orders (one row per day)."""
    span = Window.orderBy("order_day").rowsBetween(1 - days, Window.currentRow)
    return (
        daily.groupBy("order_day")
        .agg(money.total("total_revenue").alias("revenue"))
        .withColumn("moving_avg", F.round(F.avg(F.col("revenue").cast(money.MONEY)).over(span), 2).cast("double"))
        .orderBy("order_day")
    )
