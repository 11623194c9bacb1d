"""The registered queries in SQL over the given tables, written apart from the Spark code.

Every query is one statement; common table expressions build the layers it needs from the tables.
"""

from __future__ import annotations

import datetime as dt


def _dec(x: str) -> str:
    """The printed digits of a double as a decimal."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,8))"


def _double(decimal: str) -> str:
    """The double next to a decimal of any length."""
    return f"CAST(CAST({decimal} AS VARCHAR) AS DOUBLE)"


def _sum(x: str, digits: int | None = None) -> str:
    total = f"SUM({_dec(x)})"
    return _double(total if digits is None else f"ROUND({total}, {digits})")


def _avg(x: str, digits: int) -> str:
    """Mean rounded half away from zero, in whole numbers."""
    s, n, unit = f"CAST(SUM({_dec(x)}) * 100000000 AS HUGEINT)", f"COUNT({x})", 10 ** (8 - digits)
    return (
        f"CASE WHEN {n} > 0 THEN SIGN({s}) * CAST((2 * ABS({s}) + {unit} * {n}) // ({2 * unit} * {n}) AS DOUBLE)"
        f" / {10 ** digits} END"
    )


def _mean(x: str) -> str:
    return f"{_sum(x)} / COUNT({x})"


def _round(x: str, digits: int) -> str:
    """Round a double by its printed digits."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,16)), {digits}) AS DOUBLE)"


def _pct(part: str, whole: str, digits: int) -> str:
    return _round(f"(CAST({part} AS DOUBLE) / NULLIF({whole}, 0) * 100)", digits)


ORDERS = """
orders_feed AS (
  SELECT printf('O%07d', l_orderkey) AS order_id, printf('C%05d', o_custkey) AS customer_id,
    printf('P%04d', l_partkey) AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
    floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 AS unit_price,
    floor(l_extendedprice * (1 - l_discount) * 100 + 0.5) / 100 AS total_amount,
    CASE l_returnflag || l_linestatus WHEN 'RF' THEN 'returned' WHEN 'AF' THEN 'cancelled'
      WHEN 'NO' THEN 'pending' ELSE 'completed' END AS status,
    CAST(o_orderdate AS TIMESTAMP) AS order_date, n_name AS ship_country
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
silver_orders AS (
  SELECT * FROM orders_feed
  WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND total_amount > 0)"""

PRODUCTS = f"""
products_feed AS (
  SELECT p_partkey, p_name, p_type, p_brand, p_size, 1 AS delivery,
    floor(p_retailprice * CAST(1.1 AS DOUBLE) * 100 + 0.5) / 100 AS price FROM part
  UNION ALL
  SELECT p_partkey, p_name, p_type, p_brand, p_size, 2, p_retailprice FROM part WHERE p_size <= 25),
products_raw AS (
  SELECT f.*, floor(p.p_retailprice * (30 + f.p_size * CAST(1.6 AS DOUBLE)) / 100 * 100 + 0.5) / 100 AS cost
  FROM products_feed f JOIN part p USING (p_partkey)),
silver_products AS (
  SELECT printf('P%04d', p_partkey) AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
    price, cost, {_round('((price - cost) / NULLIF(price, 0) * 100)', 2)} AS margin_pct,
    CAST(p_partkey * 37 % 501 AS INTEGER) AS stock_qty, 3 + CAST(p_partkey % 21 AS DOUBLE) / 10 AS rating
  FROM products_raw
  QUALIFY ROW_NUMBER() OVER (PARTITION BY p_partkey ORDER BY delivery DESC) = 1)"""

CLICKS = """
clicks_feed AS (
  SELECT printf('E%08d', event_id) AS event_id, printf('C%05d', user_id) AS customer_id,
    CASE WHEN event_type IN ('view', 'click', 'purchase')
      THEN printf('P%04d', CAST(json_extract_string(props, '$.k') AS BIGINT)) END AS product_id,
    CASE event_type WHEN 'view' THEN 'view_product' WHEN 'click' THEN 'add_to_cart'
      WHEN 'signup' THEN 'home_page' ELSE event_type END AS event_type,
    'S' || user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
    CASE user_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device,
    date_trunc('second', ts) AS ts
  FROM events),
silver_clickstream AS (
  SELECT event_id, customer_id, product_id, event_type, session_id, device, ts AS event_ts
  FROM clicks_feed WHERE event_id IS NOT NULL)"""

CUSTOMERS = """
base_customers AS (
  SELECT printf('C%05d', c_custkey) AS customer_id, split_part(c_name, '#', 1) AS first_name,
    split_part(c_name, '#', 2) AS last_name, 'user' || c_custkey || '@mail.example.com' AS email,
    n_name AS country,
    CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Premium'
      WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'Standard' ELSE 'Budget' END AS segment,
    strftime(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER), '%Y-%m-%d') AS signup_date, c_acctbal
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
customer_changes AS (
  SELECT * EXCLUDE (c_acctbal), TRUE AS is_active, 'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version
  FROM base_customers
  UNION ALL
  SELECT * EXCLUDE (c_acctbal) REPLACE ('Premium' AS segment), TRUE, 'update', 2
  FROM base_customers WHERE c_acctbal > 8000 OR c_acctbal < -900
  UNION ALL
  SELECT * EXCLUDE (c_acctbal), FALSE, 'update', 3 FROM base_customers WHERE c_acctbal < 0
  UNION ALL
  SELECT * EXCLUDE (c_acctbal), FALSE, 'delete', 4 FROM base_customers WHERE c_acctbal < -900),
silver_customers AS (
  SELECT * EXCLUDE (_change_type, _commit_version) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY _commit_version DESC) AS rn
    FROM customer_changes) WHERE rn = 1 AND _change_type <> 'delete'),
current_customers AS (SELECT * EXCLUDE (rn) FROM silver_customers)"""

DAILY = f"""
gold_revenue_daily AS (
  SELECT CAST(order_date AS DATE) AS order_day, ship_country, COUNT(DISTINCT order_id) AS order_count,
    {_sum('total_amount', 2)} AS total_revenue, {_avg('total_amount', 2)} AS avg_order_value,
    COUNT(*) FILTER (WHERE status = 'returned') AS returns,
    COUNT(*) FILTER (WHERE status = 'cancelled') AS cancellations
  FROM silver_orders WHERE status IN ('completed', 'returned', 'cancelled', 'pending')
  GROUP BY ALL)"""

TOP = f"""
gold_top_products AS (
  SELECT product_id, product_name, category, brand, price, margin_pct,
    COUNT(DISTINCT order_id) AS orders_count, CAST(SUM(quantity) AS BIGINT) AS units_sold,
    {_sum('total_amount', 2)} AS total_revenue,
    {_pct("COUNT(*) FILTER (WHERE status = 'returned')", "COUNT(*)", 2)} AS return_rate_pct
  FROM silver_orders JOIN silver_products USING (product_id) GROUP BY 1, 2, 3, 4, 5, 6)"""

SESSIONS = f"""
gold_cart_abandonment AS (
  SELECT session_id, customer_id, COUNT(*) AS event_count, MIN(event_ts) AS session_start,
    MAX(event_ts) AS session_end,
    {_round('(CAST(epoch(MAX(event_ts)) - epoch(MIN(event_ts)) AS DOUBLE) / 60)', 1)} AS duration_mins,
    bool_or(event_type = 'add_to_cart') AND NOT bool_or(event_type = 'purchase') AS abandoned
  FROM silver_clickstream GROUP BY 1, 2)"""


def _ltv(as_of: dt.date) -> str:
    return f"""
gold_customer_ltv AS (
  SELECT customer_id, segment, country, is_active, COUNT(DISTINCT order_id) AS total_orders,
    {_sum('total_amount', 2)} AS lifetime_value, {_avg('total_amount', 2)} AS avg_order_value,
    MAX(order_date) AS last_order_date,
    CAST(date_diff('day', MAX(CAST(order_date AS DATE)), DATE '{as_of}') AS INTEGER) AS days_since_last_order
  FROM current_customers LEFT JOIN silver_orders USING (customer_id)
  WHERE status = 'completed' OR status IS NULL GROUP BY 1, 2, 3, 4)"""


REPORT = "product_name, category, brand, units_sold, total_revenue, margin_pct, return_rate_pct"
ORDER_FIELDS = "order_id, customer_id, product_id, quantity, unit_price, total_amount, status, order_date, ship_country"
CLICK_FIELDS = "event_id, customer_id, product_id, event_type, session_id, device"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


# The rows that are landed as files: good ones and some to be rejected.
LANDED_ORDERS = """
landed_orders AS (
  SELECT * FROM silver_orders
  UNION ALL SELECT * REPLACE (-total_amount AS total_amount) FROM silver_orders WHERE status = 'returned'
  UNION ALL SELECT * REPLACE (NULL AS customer_id) FROM silver_orders WHERE status = 'cancelled')"""
LANDED_CLICKS = """
landed_clicks AS (
  SELECT * FROM clicks_feed
  UNION ALL SELECT * REPLACE (NULL AS event_id) FROM clicks_feed WHERE event_type = 'error')"""


def _check_line(dataset: str, name: str, action: str, source: str, condition: str) -> str:
    good = f"COUNT(*) FILTER (WHERE {condition})"
    return (
        f"SELECT '{dataset}' AS dataset, '{name}' AS constraint_name, '{action}' AS action, "
        f"{good} AS passed, COUNT(*) - {good} AS failed FROM {source}"
    )


def _check_lines(orders: str, clicks: str) -> str:
    pages = "'view_product', 'add_to_cart', 'remove_from_cart', 'checkout', 'purchase', 'search', 'home_page'"
    statuses = "'completed', 'returned', 'cancelled', 'pending'"
    return "\nUNION ALL ".join(
        [
            _check_line("silver_orders", "valid_order_id", "drop", orders, "order_id IS NOT NULL"),
            _check_line("silver_orders", "valid_customer", "drop", orders, "customer_id IS NOT NULL"),
            _check_line("silver_orders", "positive_amount", "drop", orders, "total_amount > 0"),
            _check_line("silver_orders", "valid_status", "warn", orders, f"status IN ({statuses})"),
            _check_line("silver_clickstream", "valid_event_id", "drop", clicks, "event_id IS NOT NULL"),
            _check_line("silver_clickstream", "valid_event_type", "warn", clicks, f"event_type IN ({pages})"),
        ]
    )


def _streamed() -> dict[str, str]:
    """What the streams make of the landed rows."""
    batch = (
        "CASE WHEN order_id <= (SELECT printf('O%07d', MAX(o_orderkey) // 2) FROM orders) OR quantity < 10 "
        "THEN 'batch1' ELSE 'batch2' END"
    )
    tables = (
        "bronze_orders bronze_products bronze_clickstream bronze_customers_cdc silver_orders silver_orders_rejects "
        "silver_products silver_clickstream silver_clickstream_rejects silver_customers silver_checks "
        "gold_revenue_daily gold_top_products gold_cart_abandonment gold_customer_ltv"
    ).split()
    return {
        "ingested_orders": _with(ORDERS, LANDED_ORDERS)
        + f"""SELECT {ORDER_FIELDS}, TRUE AS file_is_older, {batch} AS delivery,
  CASE WHEN {batch} = 'batch2' THEN '{{"channel":"' || CASE quantity % 2 WHEN 0 THEN 'web' ELSE 'shop' END || '"}}' END AS beyond
FROM landed_orders""",
        "ingested_products": _with(PRODUCTS)
        + """SELECT printf('P%04d', p_partkey) AS product_id, p_name AS name, p_type AS category, p_brand AS brand,
  price, cost, p_partkey * 37 % 501 AS stock_qty, 3 + CAST(p_partkey % 21 AS DOUBLE) / 10 AS rating,
  CASE WHEN delivery = 2 THEN '{"shelf":' || p_partkey * 37 % 501 % 7 || '}' END AS beyond
FROM products_raw""",
        "ingested_clickstream": _with(CLICKS, LANDED_CLICKS)
        + f"""SELECT {CLICK_FIELDS}, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
  CASE WHEN second(ts) % 3 = 2
    THEN '{{"page":{{"kind":"' || device || '","width":' || length(session_id) || '}}}}' END AS beyond
FROM landed_clicks""",
        "streamed_rejects": _with(ORDERS, LANDED_ORDERS)
        + """SELECT order_id, product_id, status, total_amount,
  CASE WHEN customer_id IS NULL THEN 'valid_customer' ELSE 'positive_amount' END AS reasons
FROM landed_orders WHERE customer_id IS NULL OR total_amount <= 0""",
        "streamed_click_rejects": _with(CLICKS, LANDED_CLICKS)
        + """SELECT session_id, customer_id, event_type, ts AS event_ts, 'valid_event_id' AS reasons
FROM landed_clicks WHERE event_id IS NULL""",
        "streamed_dq_metrics": _with(ORDERS, LANDED_ORDERS, CLICKS, LANDED_CLICKS)
        + "SELECT dataset, constraint_name, action, passed, failed FROM ("
        + _check_lines("landed_orders", "landed_clicks")
        + ")",
        "interval_silver_orders": _with(ORDERS) + "SELECT * FROM silver_orders",
        "full_refresh_difference": f"""SELECT unnest({tables}) AS table_name,
  CAST(0 AS BIGINT) AS only_first, CAST(0 AS BIGINT) AS only_second""",
    }


def _dq() -> dict[str, str]:
    refunds = (
        ORDERS
        + """,
refund_feed AS (
  SELECT * REPLACE (
    CASE WHEN status = 'returned' THEN -total_amount ELSE total_amount END AS total_amount,
    CASE WHEN status <> 'cancelled' THEN customer_id END AS customer_id,
    CASE WHEN status = 'pending' THEN 'Pending' ELSE status END AS status)
  FROM orders_feed)"""
    )

    return {
        "dq_metrics": _with(refunds, CLICKS) + _check_lines("refund_feed", "clicks_feed"),
        "dq_rejects": _with(refunds)
        + """SELECT order_id, product_id, status, total_amount,
  CASE WHEN customer_id IS NULL THEN 'valid_customer' ELSE 'positive_amount' END AS reasons
FROM refund_feed WHERE customer_id IS NULL OR total_amount <= 0""",
    }


def _layers(as_of: dt.date) -> dict[str, str]:
    ltv = _with(CUSTOMERS, ORDERS, _ltv(as_of)) + "SELECT * FROM gold_customer_ltv"
    layers = {
        "silver_orders": _with(ORDERS) + "SELECT * FROM silver_orders",
        "silver_products": _with(PRODUCTS) + "SELECT * FROM silver_products",
        "silver_clickstream": _with(CLICKS) + "SELECT * FROM silver_clickstream",
        "silver_customers": _with(CUSTOMERS) + "SELECT * FROM current_customers",
        "gold_revenue_daily": _with(ORDERS, DAILY) + "SELECT * FROM gold_revenue_daily",
        "gold_top_products": _with(ORDERS, PRODUCTS, TOP) + "SELECT * FROM gold_top_products",
        "gold_cart_abandonment": _with(CLICKS, SESSIONS) + "SELECT * FROM gold_cart_abandonment",
        "gold_customer_ltv": ltv,
    }
    return layers | {
        "streamed_silver_orders": layers["silver_orders"],
        "streamed_silver_clickstream": layers["silver_clickstream"],
        "streamed_silver_customers": layers["silver_customers"],
        "refreshed_silver_products": layers["silver_products"],
        "refreshed_revenue_daily": layers["gold_revenue_daily"],
        "refreshed_top_products": layers["gold_top_products"],
        "refreshed_cart_abandonment": layers["gold_cart_abandonment"],
        "refreshed_customer_ltv": ltv,
        "ingested_customer_changes": _with(CUSTOMERS) + "SELECT * FROM customer_changes",
    }


def _on_daily(as_of: dt.date, month_day: dt.date, week: tuple[dt.date, dt.date]) -> dict[str, str]:
    trend = f"""
trend AS (
  SELECT order_day, {_sum('total_revenue')} AS revenue, CAST(SUM(order_count) AS BIGINT) AS orders,
    {_mean('avg_order_value')} AS avg_order_value
  FROM gold_revenue_daily GROUP BY 1)"""
    weekly = f"""
weekly AS (
  SELECT CAST(date_trunc('week', order_day) AS TIMESTAMP) AS week_start, {_sum('total_revenue')} AS weekly_revenue
  FROM gold_revenue_daily GROUP BY 1)"""
    totals = f"""
totals AS (
  SELECT {_sum('total_revenue')} AS revenue, CAST(SUM(order_count) AS BIGINT) AS orders FROM gold_revenue_daily)"""
    base = (ORDERS, DAILY)
    return {
        "revenue_trend": _with(*base, trend) + "SELECT * FROM trend",
        "revenue_by_country": _with(*base)
        + f"""SELECT ship_country AS country, {_sum('total_revenue')} AS total_revenue,
  CAST(SUM(order_count) AS BIGINT) AS total_orders FROM gold_revenue_daily GROUP BY 1""",
        "bi_counters": _with(*base, trend)
        + f"""SELECT {_sum('revenue')} AS total_revenue, CAST(SUM(orders) AS BIGINT) AS total_orders,
  {_mean('avg_order_value')} AS avg_order_value FROM trend""",
        "month_revenue": _with(*base)
        + f"""SELECT {_sum('total_revenue', 2)} AS current_month_revenue,
  CAST(SUM(order_count) AS BIGINT) AS current_month_orders FROM gold_revenue_daily
WHERE date_trunc('month', order_day) = date_trunc('month', DATE '{month_day}')""",
        "weekly_revenue": _with(*base, weekly) + "SELECT * FROM weekly",
        "wow_revenue": _with(*base, weekly)
        + f"""SELECT week_start, weekly_revenue, prev_week_revenue,
  {_round('((weekly_revenue - prev_week_revenue) / NULLIF(prev_week_revenue, 0) * 100)', 1)} AS wow_change_pct
FROM (SELECT *, LAG(weekly_revenue) OVER (ORDER BY week_start) AS prev_week_revenue FROM weekly)
ORDER BY week_start DESC LIMIT 8""",
        "moving_avg_7d": _with(
            *base,
            f"days AS (SELECT order_day, {_sum('total_revenue')} AS revenue FROM gold_revenue_daily GROUP BY 1)",
            "numbered AS (SELECT *, ROW_NUMBER() OVER (ORDER BY order_day) AS n FROM days)",
        )
        + f"""SELECT a.order_day, a.revenue, {_avg('b.revenue', 2)} AS moving_avg
FROM numbered a JOIN numbered b ON b.n BETWEEN a.n - 6 AND a.n GROUP BY 1, 2""",
        "revenue_range": _with(*base)
        + """SELECT order_day, ship_country, order_count, total_revenue, avg_order_value FROM gold_revenue_daily
WHERE order_day BETWEEN DATE '2000-01-01' AND DATE '2000-03-31'""",
        "revenue_last_week_best_country": _with(
            *base,
            f"""
by_country AS (
  SELECT ship_country, SUM({_dec('total_revenue')}) AS revenue FROM gold_revenue_daily
  WHERE order_day BETWEEN DATE '{week[0]}' AND DATE '{week[1]}' GROUP BY 1)""",
        )
        + """SELECT CAST(CAST(SUM(revenue) AS VARCHAR) AS DOUBLE) AS week_revenue,
  (SELECT ship_country FROM by_country ORDER BY revenue DESC, ship_country LIMIT 1) AS best_country,
  CAST(CAST(MAX(revenue) AS VARCHAR) AS DOUBLE) AS best_country_revenue FROM by_country""",
        "return_rate_by_country": _with(*base)
        + f"""SELECT ship_country, CAST(SUM(returns) AS BIGINT) AS returns, CAST(SUM(order_count) AS BIGINT) AS orders,
  {_pct('SUM(returns)', 'SUM(order_count)', 2)} AS return_rate_pct FROM gold_revenue_daily GROUP BY 1""",
        "kpi_totals": _with(*base, totals) + "SELECT * FROM totals",
        "kpi_aov": _with(*base, totals) + "SELECT revenue / orders AS aov FROM totals",
        "kpi_cards": _with(
            *base,
            CUSTOMERS,
            _ltv(as_of),
            totals,
            f"value AS (SELECT {_avg('lifetime_value', 2)} AS avg_ltv FROM gold_customer_ltv WHERE lifetime_value > 0)",
        )
        + """SELECT 'Total Revenue' AS label, '$' || format('{:,.0f}', revenue) AS value FROM totals
UNION ALL SELECT 'Total Orders', format('{:,}', orders) FROM totals
UNION ALL SELECT 'Avg Order Value', '$' || format('{:,.2f}', revenue / orders) FROM totals
UNION ALL SELECT 'Avg Customer LTV', '$' || format('{:,.2f}', avg_ltv) FROM value""",
        "trend_last_30d": _with(*base)
        + f"""SELECT order_day AS day, {_sum('total_revenue')} AS revenue FROM gold_revenue_daily
WHERE order_day >= (SELECT MAX(order_day) FROM gold_revenue_daily) - 30 GROUP BY 1""",
        "serving_revenue_by_country": _with(*base)
        + f"SELECT ship_country AS country, {_sum('total_revenue')} AS revenue FROM gold_revenue_daily GROUP BY 1",
    }


def _on_products(month_day: dt.date, week: tuple[dt.date, dt.date]) -> dict[str, str]:
    base = _with(ORDERS, PRODUCTS, TOP)
    categories = f"""SELECT category, COUNT(product_id) AS product_count, CAST(SUM(units_sold) AS BIGINT) AS total_units,
  {_sum('total_revenue', 2)} AS total_revenue, {_avg('margin_pct', 1)} AS avg_margin_pct,
  {_avg('return_rate_pct', 1)} AS avg_return_rate FROM gold_top_products GROUP BY 1"""
    best = "ORDER BY total_revenue DESC, product_id LIMIT"
    sold = (
        f"SELECT product_id, product_name, category, CAST(SUM(quantity) AS BIGINT) AS units_sold, "
        f"{_sum('total_amount', 2)} AS total_revenue"
    )
    joined = "FROM silver_orders JOIN silver_products USING (product_id)"
    return {
        "top10_products": base + f"SELECT {REPORT} FROM gold_top_products {best} 10",
        "category_summary": base + categories,
        "best_margin_category": base
        + f"SELECT category, avg_margin_pct FROM ({categories}) ORDER BY avg_margin_pct DESC, category LIMIT 1",
        "top_n_category": base + f"SELECT {REPORT} FROM gold_top_products WHERE category = 'ECONOMY' {best} 25",
        "top_n_all": base + f"SELECT {REPORT} FROM gold_top_products WHERE category IS NOT NULL {best} 40",
        "high_return_products": base
        + f"SELECT product_id, {REPORT} FROM gold_top_products WHERE category = 'PROMO' AND return_rate_pct > 20",
        "high_return_margin": base
        + f"""SELECT COUNT(*) FILTER (WHERE return_rate_pct > 20) AS products,
  {_avg('CASE WHEN return_rate_pct > 20 THEN margin_pct END', 1)} AS avg_margin_pct,
  {_avg('margin_pct', 1)} AS category_avg_margin_pct FROM gold_top_products WHERE category = 'PROMO'""",
        "top5_category_flagged": base
        + f"""SELECT {REPORT}, return_rate_pct > 15 AS high_return FROM gold_top_products
WHERE category = 'STANDARD' {best} 5""",
        "serving_top_products": base
        + f"SELECT product_name AS name, total_revenue AS revenue FROM gold_top_products {best} 10",
        "serving_top_product_labels": base
        + f"""SELECT product_name AS name, total_revenue AS revenue,
  CASE WHEN length(product_name) > 18 THEN substr(product_name, 1, 18) || '...' ELSE product_name END AS label
FROM gold_top_products {best} 10""",
        "best_product_by_country": _with(ORDERS, PRODUCTS)
        + f"""{sold}, ship_country {joined}
WHERE CAST(order_date AS DATE) BETWEEN DATE '{week[0]}' AND DATE '{week[1]}'
GROUP BY product_id, product_name, category, ship_country
QUALIFY ROW_NUMBER() OVER (PARTITION BY ship_country ORDER BY total_revenue DESC, product_id) = 1""",
        "top5_this_month": _with(ORDERS, PRODUCTS)
        + f"""{sold} {joined} WHERE date_trunc('month', order_date) = date_trunc('month', DATE '{month_day}')
GROUP BY product_id, product_name, category {best} 5""",
        "weekly_category_revenue": _with(ORDERS, PRODUCTS)
        + f"""SELECT CAST(date_trunc('week', order_date) AS TIMESTAMP) AS week_start, category,
  {_sum('total_amount', 2)} AS total_revenue {joined} GROUP BY 1, 2""",
    }


def _on_sessions(as_of: dt.date) -> dict[str, str]:
    base = (CLICKS, SESSIONS)

    def rates(days: int) -> str:
        return f"""SELECT CAST(session_start AS DATE) AS day, COUNT(*) AS total_sessions,
  COUNT(*) FILTER (WHERE abandoned) AS abandoned_sessions,
  {_pct('COUNT(*) FILTER (WHERE abandoned)', 'COUNT(*)', 1)} AS abandonment_rate_pct
FROM gold_cart_abandonment WHERE session_start >= DATE '{as_of}' - {days} GROUP BY 1"""

    early = "CASE WHEN half = 1 THEN abandonment_rate_pct END"
    late = "CASE WHEN half = 2 THEN abandonment_rate_pct END"
    return {
        "sessions_per_day": _with(*base)
        + "SELECT CAST(session_start AS DATE) AS day, COUNT(*) AS total_sessions FROM gold_cart_abandonment GROUP BY 1",
        "abandonment_rate": _with(*base) + rates(14),
        "abandoned_pct": _with(*base)
        + f"""SELECT COUNT(*) AS total_sessions, COUNT(*) FILTER (WHERE abandoned) AS abandoned_sessions,
  {_pct('COUNT(*) FILTER (WHERE abandoned)', 'COUNT(*)', 1)} AS abandonment_rate_pct FROM gold_cart_abandonment""",
        "abandonment_trend": _with(
            *base,
            f"rates AS ({rates(30)})",
            "halves AS (SELECT *, NTILE(2) OVER (ORDER BY day) AS half FROM rates)",
            f"ends AS (SELECT {_avg(early, 2)} AS earlier_pct, {_avg(late, 2)} AS later_pct FROM halves)",
        )
        + """SELECT *, CASE WHEN later_pct > earlier_pct THEN 'up' WHEN later_pct < earlier_pct THEN 'down'
  ELSE 'flat' END AS trend FROM ends""",
        "category_revenue_vs_abandonment": _with(
            ORDERS,
            PRODUCTS,
            *base,
            f"""
earned AS (
  SELECT category, {_sum('total_amount', 2)} AS total_revenue
  FROM silver_orders JOIN silver_products USING (product_id) GROUP BY 1),
carts AS (
  SELECT DISTINCT c.session_id, c.customer_id, p.category, s.abandoned
  FROM silver_clickstream c JOIN silver_products p USING (product_id)
  JOIN gold_cart_abandonment s ON s.session_id = c.session_id AND s.customer_id = c.customer_id
  WHERE c.event_type = 'add_to_cart'),
rates AS (
  SELECT category, COUNT(*) AS cart_sessions,
    {_pct('COUNT(*) FILTER (WHERE abandoned)', 'COUNT(*)', 1)} AS abandonment_rate_pct FROM carts GROUP BY 1)""",
        )
        + "SELECT * FROM earned LEFT JOIN rates USING (category)",
    }


def _on_ltv(as_of: dt.date) -> dict[str, str]:
    base = _with(CUSTOMERS, ORDERS, _ltv(as_of))
    risk = "customer_id, segment, country, lifetime_value, days_since_last_order"
    best = "ORDER BY lifetime_value DESC, customer_id LIMIT"
    cells = ",\n  ".join(
        f"""{_avg(f"CASE WHEN country = 'NATION_{i}' THEN lifetime_value END", 2)} AS "NATION_{i}" """ for i in range(25)
    )
    return {
        "ltv_by_segment_country": base
        + f"""SELECT segment, country, COUNT(customer_id) AS customer_count, {_mean('lifetime_value')} AS avg_ltv,
  CAST(SUM(total_orders) AS DOUBLE) / COUNT(*) AS avg_orders FROM gold_customer_ltv GROUP BY 1, 2""",
        "at_risk_customers": base
        + f"""SELECT {risk} FROM gold_customer_ltv
WHERE lifetime_value >= 250000 AND days_since_last_order >= 120 AND is_active {best} 100""",
        "premium_top_customers": base
        + f"""SELECT customer_id, segment, country, lifetime_value, total_orders FROM gold_customer_ltv
WHERE segment = 'Premium' AND lifetime_value IS NOT NULL {best} 10""",
        "premium_idle": base
        + f"""SELECT {risk} FROM gold_customer_ltv WHERE segment = 'Premium' AND lifetime_value >= 1000
  AND days_since_last_order >= 90 AND is_active""",
        "ltv_heatmap": base + f"SELECT segment, {cells} FROM gold_customer_ltv GROUP BY 1",
        "kpi_avg_ltv": base
        + f"SELECT {_avg('lifetime_value', 2)} AS avg_ltv FROM gold_customer_ltv WHERE lifetime_value > 0",
        "segments": base
        + f"""SELECT segment, COUNT(*) AS count, {_avg('lifetime_value', 2)} AS avg_ltv
FROM gold_customer_ltv GROUP BY 1""",
        "publish_stale": _with(CUSTOMERS, ORDERS, PRODUCTS, TOP, _ltv(as_of))
        + """, sides AS (
  SELECT customer_id AS key, substr(md5(customer_id), 1, 2) AS range, right(customer_id, 2) = '99' AS gone,
    right(customer_id, 2) = '13' AND lifetime_value IS NOT NULL AS changed FROM gold_customer_ltv)
SELECT 'gold_customer_ltv' AS table_name, 'customer_id' AS key_columns, 'FAILED' AS state, range,
  COUNT(*) AS source_rows, COUNT(*) FILTER (NOT gone) AS copy_rows, MIN(key) AS first_key, MAX(key) AS last_key
FROM sides GROUP BY range HAVING bool_or(gone OR changed)
UNION ALL SELECT 'gold_top_products', 'product_id', 'ONLINE', NULL, COUNT(*), COUNT(*), NULL, NULL FROM gold_top_products""",
        "publish_reconcile": _with(CUSTOMERS, ORDERS, PRODUCTS, DAILY, TOP, _ltv(as_of))
        + """SELECT 'gold_revenue_daily' AS table_name, 'order_day,ship_country' AS key_columns,
  COUNT(*) AS source_rows, COUNT(DISTINCT (order_day, ship_country)) AS copy_rows, 'ONLINE' AS state
FROM gold_revenue_daily
UNION ALL SELECT 'gold_top_products', 'product_id', COUNT(*), COUNT(DISTINCT product_id), 'ONLINE'
FROM gold_top_products
UNION ALL SELECT 'gold_customer_ltv', 'customer_id', COUNT(*), COUNT(DISTINCT customer_id), 'ONLINE'
FROM gold_customer_ltv""",
    }


def _governed() -> dict[str, str]:
    masked = "substr(split_part(email, '@', 1), 1, 3) || '***@***.***'"
    people = ("analyst_NATION_3", "steward_NATION_3")
    return {
        "masked_customers": _with(CUSTOMERS)
        + f"""SELECT '{people[0]}' AS principal, customer_id, first_name, {masked} AS email, segment
FROM current_customers
UNION ALL SELECT '{people[1]}', customer_id, first_name, email, segment FROM current_customers""",
        "masked_customers_sample": _with(CUSTOMERS)
        + f"""SELECT customer_id, first_name, {masked} AS email, segment FROM current_customers
ORDER BY customer_id LIMIT 10""",
        "tag_masked_customers": _with(CUSTOMERS)
        + f"""SELECT '{people[0]}' AS principal, customer_id, first_name[1] || '***' AS first_name,
  last_name[1] || '***' AS last_name, {masked} AS email, country FROM current_customers
UNION ALL SELECT '{people[1]}', customer_id, first_name, last_name, email, country FROM current_customers""",
        "filtered_orders": _with(ORDERS)
        + """SELECT 'analyst_NATION_3' AS principal, order_id, product_id, total_amount, ship_country
FROM silver_orders WHERE ship_country = 'NATION_7'
UNION ALL SELECT 'admin_NATION_3', order_id, product_id, total_amount, ship_country FROM silver_orders""",
        "sql_masked_customers": _with(CUSTOMERS)
        + f"SELECT customer_id, first_name, {masked} AS email, segment FROM current_customers",
        "sql_filtered_orders": _with(ORDERS)
        + "SELECT order_id, product_id, total_amount, ship_country FROM silver_orders WHERE ship_country = 'NATION_7'",
        "principal_orders": _with(ORDERS)
        + """SELECT * FROM silver_orders WHERE ship_country IN (
  SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')""",
    }


def _conversations() -> dict[str, str]:
    index = """
session_index AS (
  SELECT conv_id, COALESCE(
      MAX(CASE WHEN turn = first_user THEN
        CASE WHEN length(text) > 80 THEN substr(text, 1, 80) || '...' ELSE text END END),
      'New conversation') AS title,
    MIN(turn) AS created_at, MAX(turn) AS updated_at
  FROM (SELECT *, MIN(turn) FILTER (WHERE role = 'user') OVER (PARTITION BY conv_id) AS first_user
        FROM conversations)
  GROUP BY 1)"""
    kept = "(SELECT conv_id FROM conversations WHERE role = 'assistant')"
    return {
        "session_messages": "SELECT conv_id, turn, role, text AS content FROM conversations",
        "session_index": _with(index) + "SELECT * FROM session_index",
        "session_list": _with(index) + "SELECT * FROM session_index",
        "packed_prompts": """WITH marked AS (
  SELECT *, turn // 256 AS part, MAX(turn) OVER (PARTITION BY conv_id) AS last_turn,
    MIN(turn) OVER (PARTITION BY conv_id) AS first_turn, COUNT(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations)
SELECT conv_id, part, string_agg(
  CASE WHEN n = 1 THEN text
    ELSE CASE WHEN turn = first_turn THEN 'Here is our conversation so far:' || chr(10) ELSE '' END ||
      CASE WHEN turn = last_turn THEN chr(10) || 'Now answer this follow-up question: ' || text
        ELSE CASE WHEN role = 'user' THEN 'User' ELSE 'Assistant' END || ': ' || text END END,
  chr(10) ORDER BY turn) AS prompt
FROM marked GROUP BY 1, 2""",
        "deleted_sessions": f"""SELECT conv_id, turn, role, text AS content FROM conversations
WHERE conv_id IN {kept}""",
        "deleted_sessions_index": _with(index) + f"SELECT * FROM session_index WHERE conv_id IN {kept}",
        "response_answers": """SELECT conv_id, turn, CASE WHEN role = 'assistant' AND text <> '' THEN text
  ELSE 'I couldn''t process that request. Please try rephrasing your question.' END AS answer FROM conversations""",
        "appended_turns": _with(index)
        + """SELECT conv_id, turn, role, text AS content FROM conversations
UNION ALL SELECT conv_id, updated_at + 1, 'user', 'More on: ' || title FROM session_index
UNION ALL SELECT conv_id, updated_at + 2, 'assistant', 'Noted.' FROM session_index""",
    }


class _Draws:
    """Words of the hash that the sample feeds draw from, for a row number ``id``."""

    def __init__(self, feed: str):
        self.feed = feed

    def below(self, place: int, bound: str) -> str:
        block, word = divmod(place, 4)
        digest = f"md5('42:{self.feed}:{block}:' || id)"
        return f"((CAST('0x' || substr({digest}, {8 * word + 1}, 8) AS BIGINT) * ({bound})) >> 32)"

    def one_of(self, place: int, values: list[str]) -> str:
        items = ", ".join(f"'{v}'" for v in values)
        return f"([{items}])[CAST({self.below(place, str(len(values)))} + 1 AS INTEGER)]"

    def weighted(self, place: int, weights: dict[str, int]) -> str:
        return self.one_of(place, [v for v, w in weights.items() for _ in range(w)])


def _generated() -> dict[str, str]:
    countries = {"US": 4, "GB": 1, "DE": 1, "FR": 1, "CA": 1, "AU": 1, "JP": 1}
    clock = (
        "strftime(TIMESTAMP '2024-01-02 00:00:00' + to_seconds(CAST(31536000 * (id - 1) // greatest(n - 1, 1) AS BIGINT)),"
        " '%Y-%m-%d %H:%M:%S')"
    )
    c, p, o, k = _Draws("customers"), _Draws("products"), _Draws("orders"), _Draws("clicks")
    people = ["Alice", "Bob", "Carol", "David", "Eve", "Frank", "Grace", "Hank", "Iris", "Jack"]
    letters = " || ".join(f"chr(CAST(65 + {c.below(i, '26')} AS INTEGER))" for i in range(1, 7))
    pages = ["view_product", "add_to_cart", "remove_from_cart", "checkout", "purchase", "search", "home_page"]
    kinds = ["Electronics", "Clothing", "Home & Garden", "Sports", "Books"]
    customers, parts = "(SELECT COUNT(*) FROM customer)", "(SELECT COUNT(*) FROM part)"
    return {
        "generated_customers": f"""WITH ids AS (SELECT c_custkey + 1 AS id FROM customer)
SELECT printf('C%05d', id) AS customer_id, {c.one_of(0, people)} AS first_name, {letters} AS last_name,
  'user' || id || '@example.com' AS email, {c.weighted(7, countries)} AS country,
  {c.weighted(8, {"Premium": 20, "Standard": 50, "Budget": 30})} AS segment,
  strftime(DATE '2022-01-01' + CAST((id - 1) // 24 AS INTEGER), '%Y-%m-%d') AS signup_date,
  {c.below(9, '4')} < 3 AS is_active, 'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version FROM ids""",
        "generated_products": f"""WITH ids AS (SELECT p_partkey + 1 AS id FROM part),
kinds AS (SELECT id, {p.one_of(2, kinds)} AS category FROM ids),
ranges AS (SELECT * FROM (VALUES ('Electronics', 50, 1500), ('Clothing', 10, 200), ('Home & Garden', 15, 500),
  ('Sports', 20, 800), ('Books', 5, 60)) AS t(category, low, high))
SELECT printf('P%04d', id) AS product_id, category || ' Item ' || id AS name, category,
  {p.one_of(3, ["BrandA", "BrandB", "BrandC", "BrandD", "BrandE"])} AS brand,
  CAST(100 * low + {p.below(0, '100 * (high - low) + 1')} AS DOUBLE) / 100 AS price,
  CAST(40 * low + {p.below(1, '60 * high - 40 * low + 1')} AS DOUBLE) / 100 AS cost,
  {p.below(4, '501')} AS stock_qty, CAST(30 + {p.below(5, '21')} AS DOUBLE) / 10 AS rating
FROM kinds JOIN ranges USING (category)""",
        "generated_orders": f"""WITH ids AS (SELECT o_orderkey + 1 AS id, (SELECT COUNT(*) FROM orders) AS n FROM orders),
priced AS (SELECT *, 1 + {o.below(0, '5')} AS q, 500 + {o.below(1, '149501')} AS cents FROM ids)
SELECT printf('O%07d', id) AS order_id, printf('C%05d', 1 + {o.below(2, customers)}) AS customer_id,
  printf('P%04d', 1 + {o.below(3, parts)}) AS product_id, CAST(q AS INTEGER) AS quantity,
  CAST(cents AS DOUBLE) / 100 AS unit_price, CAST(q * cents AS DOUBLE) / 100 AS total_amount,
  {o.weighted(4, {"completed": 3, "returned": 1, "cancelled": 1, "pending": 1})} AS status,
  {clock} AS order_date, {o.weighted(5, countries)} AS ship_country FROM priced""",
        "generated_clicks": f"""WITH ids AS (SELECT event_id + 1 AS id, (SELECT COUNT(*) FROM events) AS n FROM events),
drawn AS (SELECT *, 1 + {k.below(0, parts + ' + 20')} AS product FROM ids)
SELECT printf('E%08d', id) AS event_id, printf('C%05d', 1 + {k.below(1, customers)}) AS customer_id,
  CASE WHEN product <= {parts} THEN printf('P%04d', product) END AS product_id,
  {k.one_of(2, pages)} AS event_type, printf('S%06d', 1 + {k.below(3, '(SELECT COUNT(*) FROM orders)')}) AS session_id,
  {k.one_of(4, ["mobile", "desktop", "tablet"])} AS device, {clock} AS ts FROM drawn""",
    }


def all_queries(
    as_of: dt.date, month_day: dt.date, clicks_as_of: dt.date, week: tuple[dt.date, dt.date]
) -> dict[str, str]:
    queries = {
        **_layers(as_of),
        **_streamed(),
        **_dq(),
        **_on_daily(as_of, month_day, week),
        **_on_products(month_day, week),
        **_on_sessions(clicks_as_of),
        **_on_ltv(as_of),
        **_governed(),
        **_conversations(),
        **_generated(),
    }
    return queries | {
        "sql_revenue_range": queries["revenue_range"],
        "sql_top_n_category": queries["top_n_category"],
        "sql_abandonment_rate": queries["abandonment_rate"],
        "sql_at_risk_customers": queries["at_risk_customers"],
    }
