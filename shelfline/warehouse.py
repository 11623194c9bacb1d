"""Silver and gold tables built from feeds in one go, each written once and read many times.

Queries over gold read these stored tables and never rebuild them from the raw rows. The order
table, by far the largest, and the sessions are stored by month.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from shelfline.functions.governance import CUSTOMER_TAGS, tag_columns
from shelfline.plans import gold, silver
from shelfline.plans.questions import ORDER_MONTH, with_order_month
from shelfline.session import clean_up_shuffles
from shelfline.sources import adapters, tables
from shelfline.sources.adapters import Tables, bronze

SILVER = ("silver_orders", "silver_products", "silver_clickstream", "silver_customers")
GOLD = ("gold_revenue_daily", "gold_top_products", "gold_cart_abandonment", "gold_customer_ltv")


# Tables that are stored by month, and the column that names it.
BY_MONTH = {"silver_orders": ORDER_MONTH, "gold_cart_abandonment": gold.SESSION_MONTH}


class Warehouse:
    def __init__(self, source: Tables, root: str, as_of: dt.date):
        self.source = source
        self.root = root
        self.as_of = as_of
        clean_up_shuffles(source.spark)
        self._stored: dict[str, DataFrame] = {}
        self._locks = {name: threading.Lock() for name in (*SILVER, *GOLD)}

    def define(self, name: str) -> DataFrame:
        """The query that makes a table, over the stored tables it is made from."""
        makers: dict[str, Callable[[], DataFrame]] = {
            "silver_orders": lambda: with_order_month(
                silver.silver_orders(bronze(adapters.orders_feed(self.source)))
            ),
            "silver_products": lambda: silver.silver_products(bronze(adapters.products_feed(self.source))),
            "silver_clickstream": lambda: silver.silver_clickstream(bronze(adapters.clicks_feed(self.source))),
            "silver_customers": lambda: tag_columns(
                silver.silver_customers(bronze(adapters.customer_changes(self.source))), CUSTOMER_TAGS
            ),
            "gold_revenue_daily": lambda: gold.gold_revenue_daily(self.table("silver_orders")),
            "gold_top_products": lambda: gold.gold_top_products(
                self.table("silver_orders"), self.table("silver_products")
            ),
            "gold_cart_abandonment": lambda: gold.with_session_month(
                gold.gold_cart_abandonment(self.table("silver_clickstream"))
            ),
            "gold_customer_ltv": lambda: gold.gold_customer_ltv(
                self.table("silver_customers"), self.table("silver_orders"), self.as_of
            ),
        }
        return makers[name]()

    def table(self, name: str) -> DataFrame:
        """The stored table, written on first use."""
        with self._locks[name]:
            if name not in self._stored:
                self._stored[name] = tables.write_version(self.define(name), f"{self.root}/{name}", BY_MONTH.get(name))
            return self._stored[name]

    def drop(self) -> None:
        """Delete the stored tables."""
        self._stored.clear()
        tables.remove(self.source.spark, self.root)

    def gold(self) -> dict[str, DataFrame]:
        """All gold tables; those that are not stored yet are written side by side."""
        with ThreadPoolExecutor(len(GOLD)) as pool:
            return dict(zip(GOLD, pool.map(self.table, GOLD)))
