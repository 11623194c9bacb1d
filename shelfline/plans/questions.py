"""Business questions asked in words, each as one query.

Questions about a span of time read silver orders. Those are stored by month, so the span is
given on the month column too and months outside it are not read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.tools import get_at_risk_customers, get_revenue_summary
from shelfline.operators import money
from shelfline.plans.bi import PRODUCT_REPORT, category_summary, top_products

ORDER_MONTH = "order_month"


def with_order_month(orders: DataFrame) -> DataFrame:
    """The column that stored orders are partitioned by."""
    return orders.withColumn(ORDER_MONTH, F.trunc("order_date", "month"))


def orders_between(orders: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Orders from ``start`` up to but without ``end``."""
    rows = orders.filter(
        (F.col("order_date") >= F.lit(start).cast("timestamp")) & (F.col("order_date") < F.lit(end).cast("timestamp"))
    )
    if ORDER_MONTH in orders.columns:
        last = end - dt.timedelta(days=1)
        rows = rows.filter(F.col(ORDER_MONTH).between(F.lit(start.replace(day=1)), F.lit(last.replace(day=1))))
    return rows


def week_before(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day of the calendar week before the one of ``as_of``."""
    monday = as_of - dt.timedelta(days=as_of.weekday())
    return monday - dt.timedelta(days=7), monday - dt.timedelta(days=1)


def last_week_best_country(daily: DataFrame, as_of: dt.date) -> DataFrame:
    """Revenue of last week and the country that brought in most of it."""
    by_country = (
        get_revenue_summary(daily, *week_before(as_of))
        .groupBy("ship_country")
        .agg(money.exact_total("total_revenue").alias("revenue"))
    )
    # One row per country is left here; the lowest name wins a tie.
    return by_country.agg(
        F.sum("revenue").cast("double").alias("week_revenue"),
        F.min_by("ship_country", F.struct(-F.col("revenue"), "ship_country")).alias("best_country"),
        F.max("revenue").cast("double").alias("best_country_revenue"),
    )


def return_rate_by_country(daily: DataFrame) -> DataFrame:
    rate = money.percent(F.sum("returns"), F.sum("order_count"), 2)
    return (
        daily.groupBy("ship_country")
        .agg(F.sum("returns").alias("returns"), F.sum("order_count").alias("orders"), rate.alias("return_rate_pct"))
        .orderBy(F.desc("return_rate_pct"), "ship_country")
    )


def best_margin_category(products: DataFrame) -> DataFrame:
    return (
        category_summary(products)
        .orderBy(F.desc("avg_margin_pct"), "category")
        .limit(1)
        .select("category", "avg_margin_pct")
    )


def abandoned_percent(sessions: DataFrame) -> DataFrame:
    abandoned = F.count_if("abandoned")
    return sessions.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        abandoned.alias("abandoned_sessions"),
        money.percent(abandoned, F.count(F.lit(1)), 1).alias("abandonment_rate_pct"),
    )


def top_customers_of_segment(ltv: DataFrame, segment: str, n: int = 10) -> DataFrame:
    return (
        ltv.filter((F.col("segment") == segment) & F.col("lifetime_value").isNotNull())
        .orderBy(F.desc("lifetime_value"), "customer_id")
        .limit(n)
        .select("customer_id", "segment", "country", "lifetime_value", "total_orders")
    )


def high_return_products(products: DataFrame, category: str, above_pct: float = 15.0) -> DataFrame:
    """Products of a category that come back more often than this."""
    return (
        products.filter((F.col("category") == category) & (F.col("return_rate_pct") > above_pct))
        .orderBy(F.desc("return_rate_pct"), "product_id")
        .select("product_id", *PRODUCT_REPORT)
    )


def high_return_margin(products: DataFrame, category: str, above_pct: float = 15.0) -> DataFrame:
    """How many such products there are, and their mean margin beside that of the category."""
    risky = F.col("return_rate_pct") > above_pct
    return products.filter(F.col("category") == category).agg(
        F.count_if(risky).alias("products"),
        money.rounded_mean(F.when(risky, F.col("margin_pct")), 1).alias("avg_margin_pct"),
        money.rounded_mean("margin_pct", 1).alias("category_avg_margin_pct"),
    )


def _revenue_by_product(orders: DataFrame, *groups: str) -> DataFrame:
    return orders.groupBy("product_id", *groups).agg(
        F.sum("quantity").alias("units_sold"), money.rounded_total("total_amount").alias("total_revenue")
    )


def best_product_by_country(orders: DataFrame, products: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """The product that earned most in each country in the span, both days included."""
    sold = _revenue_by_product(
        orders_between(orders, start, end + dt.timedelta(days=1)).filter(F.col("product_id").isNotNull()),
        "ship_country",
    )
    place = F.row_number().over(Window.partitionBy("ship_country").orderBy(F.desc("total_revenue"), "product_id"))
    names = products.select("product_id", "product_name", "category")
    return sold.join(names, "product_id").withColumn("place", place).filter("place = 1").drop("place")


def top_products_of_month(orders: DataFrame, products: DataFrame, as_of: dt.date, n: int = 5) -> DataFrame:
    """Best sellers of the calendar month, from the orders themselves."""
    first = as_of.replace(day=1)
    following = (first + dt.timedelta(days=32)).replace(day=1)
    sold = _revenue_by_product(orders_between(orders, first, following))
    names = products.select("product_id", "product_name", "category")
    return sold.join(names, "product_id").orderBy(F.desc("total_revenue"), "product_id").limit(n)


def premium_idle(ltv: DataFrame, min_ltv: float = 1000.0, inactive_days: int = 90) -> DataFrame:
    """All valuable Premium customers who stopped ordering."""
    return get_at_risk_customers(ltv.filter(F.col("segment") == "Premium"), min_ltv, inactive_days, limit=None)


def weekly_category_revenue(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue by week and category; orders are reduced per product and week before the join."""
    week = F.date_trunc("week", "order_date").alias("week_start")
    sold = orders.groupBy("product_id", week).agg(money.exact_total("total_amount").alias("_revenue"))
    return (
        sold.join(products.select("product_id", "category"), "product_id")
        .groupBy("week_start", "category")
        .agg(F.round(F.sum("_revenue"), 2).cast("double").alias("total_revenue"))
        .orderBy("week_start", "category")
    )


def abandonment_trend(rates: DataFrame) -> DataFrame:
    """Mean daily rate of the later half of the series against the earlier half (a row per day)."""
    numbered = rates.withColumn("_half", F.ntile(2).over(Window.orderBy("day")))

    def half(number: int) -> Column:
        return money.rounded_mean(F.when(F.col("_half") == number, F.col("abandonment_rate_pct")))

    change = F.col("later_pct") - F.col("earlier_pct")
    return numbered.agg(half(1).alias("earlier_pct"), half(2).alias("later_pct")).withColumn(
        "trend", F.when(change > 0, "up").when(change < 0, "down").otherwise("flat")
    )


def ltv_heatmap(ltv: DataFrame, countries: list[str]) -> DataFrame:
    """Mean lifetime value, one row per segment and one column per listed country."""
    return ltv.groupBy("segment").pivot("country", countries).agg(money.rounded_mean("lifetime_value"))


def flagged_top_products(products: DataFrame, category: str, n: int = 5, above_pct: float = 15.0) -> DataFrame:
    """Best sellers of a category with a mark on those that come back too often."""
    best = top_products(products.filter(F.col("category") == category), n)
    return best.withColumn("high_return", F.col("return_rate_pct") > above_pct)


def category_revenue_and_abandonment(
    orders: DataFrame, products: DataFrame, clicks: DataFrame, sessions: DataFrame
) -> DataFrame:
    """Revenue of each category beside the share of its cart sessions that were abandoned.

    A session counts for a category when one of its cart events names a product of it. Orders are
    reduced per product, and cart events per session and product, before they meet the products.
    """
    revenue = orders.groupBy("product_id").agg(money.exact_total("total_amount").alias("_revenue"))
    categories = products.select("product_id", "category")
    earned = (
        revenue.join(categories, "product_id")
        .groupBy("category")
        .agg(F.round(F.sum("_revenue"), 2).cast("double").alias("total_revenue"))
    )
    carts = (
        clicks.filter((F.col("event_type") == "add_to_cart") & F.col("product_id").isNotNull())
        .select("session_id", "customer_id", "product_id")
        .distinct()
        .join(categories, "product_id")
        .select("session_id", "customer_id", "category")
        .distinct()
        .join(sessions.select("session_id", "customer_id", "abandoned"), ["session_id", "customer_id"])
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("cart_sessions"),
            money.percent(F.count_if("abandoned"), F.count(F.lit(1)), 1).alias("abandonment_rate_pct"),
        )
    )
    return earned.join(carts, "category", "left")
