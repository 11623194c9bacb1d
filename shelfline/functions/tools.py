"""The four parameterised query tools, as Python functions and as SQL table functions.

``register`` makes the same four available to ``spark.sql("SELECT * FROM get_top_products(10, '')")``
over views with the names of the gold tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators import money
from shelfline.operators.dates import today
from shelfline.plans.bi import PRODUCT_REPORT, top_products
from shelfline.plans.gold import SESSION_MONTH

REVENUE_COLUMNS = ("order_day", "ship_country", "order_count", "total_revenue", "avg_order_value")
RISK_COLUMNS = ("customer_id", "segment", "country", "lifetime_value", "days_since_last_order")
RISK_LIMIT = 100
RANK_PARTS = 64


def get_revenue_summary(daily: DataFrame, start_date: dt.date, end_date: dt.date) -> DataFrame:
    """Daily revenue by country from ``start_date`` to ``end_date``, both included."""
    return (
        daily.filter(F.col("order_day").between(F.lit(start_date), F.lit(end_date)))
        .select(*REVENUE_COLUMNS)
        .orderBy("order_day", F.desc("total_revenue"))
    )


def get_top_products(products: DataFrame, n: int, cat_filter: str | None = "") -> DataFrame:
    """The ``n`` best sellers of a category; an empty or missing name means every named category."""
    wanted = F.col("category") == cat_filter if cat_filter else F.col("category").isNotNull()
    return top_products(products.filter(wanted), n)


def get_abandonment_rate(sessions: DataFrame, days_back: int, as_of: dt.date | None = None) -> DataFrame:
    """Share of abandoned sessions among all sessions of each day, from ``days_back`` days ago on."""
    since = F.date_sub(today(as_of), days_back)
    abandoned = F.count_if("abandoned")
    recent = sessions.filter(F.col("session_start") >= since.cast("timestamp"))
    if SESSION_MONTH in sessions.columns:
        # Stored sessions lie in the month they start in; earlier months are not read.
        recent = recent.filter(F.col(SESSION_MONTH) >= F.trunc(since, "month"))
    return (
        recent
        .groupBy(F.to_date("session_start").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("total_sessions"),
            abandoned.alias("abandoned_sessions"),
            money.percent(abandoned, F.count(F.lit(1)), 1).alias("abandonment_rate_pct"),
        )
        .orderBy("day")
    )


def get_at_risk_customers(
    ltv: DataFrame, min_ltv: float, inactive_days: int, limit: int | None = RISK_LIMIT
) -> DataFrame:
    """Active customers of at least this value who have not ordered for this long, best first; None means all."""
    lapsed = (F.col("lifetime_value") >= min_ltv) & (F.col("days_since_last_order") >= inactive_days)
    ordered = ltv.filter(lapsed & F.col("is_active")).orderBy(F.desc("lifetime_value"), "customer_id")
    return (ordered if limit is None else ordered.limit(limit)).select(*RISK_COLUMNS)


def _table_function(spark: SparkSession, name: str, arguments: str, source: DataFrame, columns, body: str) -> None:
    kinds = {field.name: field.dataType.simpleString() for field in source.schema}
    returned = ", ".join(f"{c} {kinds[c]}" for c in columns)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE ({returned}) RETURN {body}")


def register(spark: SparkSession, gold: dict[str, DataFrame], as_of: dt.date | None = None) -> None:
    """Temporary views for the gold tables and temporary SQL table functions over them.

    ``as_of`` pins "today"; without it the functions follow the session's current date.
    """
    for name, table in gold.items():
        table.createOrReplaceTempView(name)
    today = f"DATE'{as_of}'" if as_of else "current_date()"
    daily, products = gold["gold_revenue_daily"], gold["gold_top_products"]
    sessions, ltv = gold["gold_cart_abandonment"], gold["gold_customer_ltv"]
    _table_function(
        spark,
        "get_revenue_summary",
        "start_date DATE, end_date DATE",
        daily,
        REVENUE_COLUMNS,
        f"""SELECT {', '.join(REVENUE_COLUMNS)} FROM gold_revenue_daily d
        WHERE d.order_day >= start_date AND d.order_day <= end_date
        ORDER BY d.order_day, d.total_revenue DESC""",
    )
    # A parameter cannot be a LIMIT, so the cut is on a rank. Ranking within parts first leaves the
    # ranking of all rows, which is one task, at most n rows of each part.
    best_first = "ORDER BY total_revenue DESC, product_id"
    _table_function(
        spark,
        "get_top_products",
        "n INT, cat_filter STRING",
        products,
        PRODUCT_REPORT,
        f"""WITH parted AS (
          SELECT *, row_number() OVER (PARTITION BY pmod(xxhash64(product_id), {RANK_PARTS}) {best_first}) AS part_place
          FROM gold_top_products
          WHERE CASE WHEN cat_filter <> '' THEN category = cat_filter ELSE category IS NOT NULL END),
        ranked AS (SELECT *, row_number() OVER ({best_first}) AS place FROM parted WHERE part_place <= n)
        SELECT {', '.join(PRODUCT_REPORT)} FROM ranked WHERE place <= n""",
    )
    by_day = get_abandonment_rate(sessions, 0, dt.date(2000, 1, 1))
    since = f"date_sub({today}, days_back)"
    months = f"s.{SESSION_MONTH} >= trunc({since}, 'month')" if SESSION_MONTH in sessions.columns else "true"
    _table_function(
        spark,
        "get_abandonment_rate",
        "days_back INT",
        by_day,
        by_day.columns,
        f"""SELECT to_date(s.session_start), count(1), count_if(s.abandoned),
          round(avg(CAST(s.abandoned AS INT)) * 100, 1)
        FROM gold_cart_abandonment s
        WHERE s.session_start >= CAST({since} AS TIMESTAMP) AND {months}
        GROUP BY ALL ORDER BY 1""",
    )
    _table_function(
        spark,
        "get_at_risk_customers",
        "min_ltv DOUBLE, inactive_days INT",
        ltv,
        RISK_COLUMNS,
        f"""SELECT {', '.join(RISK_COLUMNS)} FROM gold_customer_ltv c
        WHERE c.is_active AND c.lifetime_value >= min_ltv AND c.days_since_last_order >= inactive_days
        ORDER BY c.lifetime_value DESC, c.customer_id LIMIT {RISK_LIMIT}""",
    )
