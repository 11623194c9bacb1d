"""Column layouts of the raw feeds (as DDL text), the keys of the published tables, and the fixed value domains."""

from __future__ import annotations

# The domains the checks and queries are defined on.
ORDER_STATUSES = ("completed", "returned", "cancelled", "pending")
EVENT_TYPES = (
    "view_product",
    "add_to_cart",
    "remove_from_cart",
    "checkout",
    "purchase",
    "search",
    "home_page",
)
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


CUSTOMER_CHANGES = (
    "customer_id string, first_name string, last_name string, email string, country string, "
    "segment string, signup_date string, is_active boolean, _change_type string, _commit_version bigint"
)
PRODUCTS = (
    "product_id string, name string, category string, brand string, price double, cost double, "
    "stock_qty bigint, rating double"
)
ORDERS = (
    "order_id string, customer_id string, product_id string, quantity int, unit_price double, "
    "total_amount double, status string, order_date string, ship_country string"
)
CLICKS = (
    "event_id string, customer_id string, product_id string, event_type string, session_id string, "
    "device string, ts string"
)

# Gold tables and the key each one is published under (sessions are not published).
PUBLISHED_KEYS = {
    "gold_revenue_daily": ("order_day", "ship_country"),
    "gold_top_products": ("product_id",),
    "gold_customer_ltv": ("customer_id",),
}
