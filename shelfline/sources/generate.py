"""Seeded sample feeds, made on the executors.

Every value is drawn from a hash of (seed, feed, row number), so a feed is the same for any number
of partitions and any subset of rows can be made alone. Each maker takes the row numbers as a
DataFrame with a column ``id`` counting from 1; :func:`ids` makes one for a wanted size.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.scalars import padded_key
from shelfline.schemas import EVENT_TYPES, TIME_FORMAT

# Default sizes and the domains of the sample feeds.
CUSTOMERS, PRODUCTS, ORDERS, CLICKS, SESSIONS = 5_000, 200, 50_000, 200_000, 20_000
FIRST_NAMES = ("Alice", "Bob", "Carol", "David", "Eve", "Frank", "Grace", "Hank", "Iris", "Jack")
COUNTRY_WEIGHTS = {"US": 4, "GB": 1, "DE": 1, "FR": 1, "CA": 1, "AU": 1, "JP": 1}
SEGMENT_WEIGHTS = {"Premium": 20, "Standard": 50, "Budget": 30}
STATUS_WEIGHTS = {"completed": 3, "returned": 1, "cancelled": 1, "pending": 1}
PRICE_RANGES = {
    "Electronics": (50, 1500),
    "Clothing": (10, 200),
    "Home & Garden": (15, 500),
    "Sports": (20, 800),
    "Books": (5, 60),
}
BRANDS = ("BrandA", "BrandB", "BrandC", "BrandD", "BrandE")
DEVICES = ("mobile", "desktop", "tablet")
SIGNUP_START = "2022-01-01"
EMAIL_DOMAIN = "example.com"
NO_PRODUCT_DRAWS = 20
SPAN_DAYS = 365


def ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1)


class _Draws:
    """Random numbers of one feed, four 32-bit words to a hash."""

    def __init__(self, seed: int, feed: str):
        self.seed, self.feed, self.used = seed, feed, 0

    def word(self) -> Column:
        block, place = divmod(self.used, 4)
        self.used += 1
        digest = F.md5(F.concat(F.lit(f"{self.seed}:{self.feed}:{block}:"), F.col("id").cast("string")))
        return F.conv(F.substring(digest, 8 * place + 1, 8), 16, 10).cast("bigint")

    def below(self, bound: int | Column) -> Column:
        """A whole number from 0 up to, without, ``bound`` (which stays below 2^31)."""
        return F.shiftright(self.word() * bound, 32)

    def one_of(self, values: Sequence[str]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (self.below(len(values)) + 1).cast("int"))

    def weighted(self, weights: dict[str, int]) -> Column:
        """A value with chances in proportion to its whole-number weight."""
        ticket, upto = self.below(sum(weights.values())), 0
        chosen = F
        for value, weight in weights.items():
            upto += weight
            chosen = chosen.when(ticket < upto, F.lit(value))
        return chosen


def _clock(n: int | Column, end: dt.datetime, span_days: int = SPAN_DAYS) -> Column:
    """Times spread evenly over the days before ``end``; the last row is at ``end``."""
    total = span_days * 86_400
    count = n if isinstance(n, Column) else F.lit(n)
    offset = F.call_function("div", total * (F.col("id") - 1), F.greatest(count - 1, F.lit(1)))
    start = int((end - dt.timedelta(days=span_days)).replace(tzinfo=dt.timezone.utc).timestamp())
    return F.date_format(F.timestamp_seconds(F.lit(start) + offset), TIME_FORMAT)


def customers(ids: DataFrame, seed: int = 42) -> DataFrame:
    """Change-feed rows: every customer inserted, in version 1; sign-ups one hour apart."""
    draw = _Draws(seed, "customers")
    letters = F.array(*[F.lit(chr(c)) for c in range(ord("A"), ord("Z") + 1)])
    first = draw.one_of(FIRST_NAMES)
    last = F.concat(*[F.element_at(letters, (draw.below(26) + 1).cast("int")) for _ in range(6)])
    day = F.date_add(F.lit(SIGNUP_START).cast("date"), F.call_function("div", F.col("id") - 1, F.lit(24)).cast("int"))
    return ids.select(
        padded_key("C", F.col("id"), 5).alias("customer_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(F.lit("user"), F.col("id"), F.lit(f"@{EMAIL_DOMAIN}")).alias("email"),
        draw.weighted(COUNTRY_WEIGHTS).alias("country"),
        draw.weighted(SEGMENT_WEIGHTS).alias("segment"),
        F.date_format(day, "yyyy-MM-dd").alias("signup_date"),
        (draw.below(4) < 3).alias("is_active"),
        F.lit("insert").alias("_change_type"),
        F.lit(1).cast("bigint").alias("_commit_version"),
    )


def products(ids: DataFrame, seed: int = 42) -> DataFrame:
    """Catalog rows; price within the category's range, cost from 0.4 of its low to 0.6 of its high."""
    draw = _Draws(seed, "products")
    ranges = F.create_map(
        *[
            part
            for name, (low, high) in PRICE_RANGES.items()
            for part in (F.lit(name), F.struct(F.lit(low).alias("low"), F.lit(high).alias("high")))
        ]
    )
    low, high = F.col("_range.low"), F.col("_range.high")
    price_cents = 100 * low + draw.below(100 * (high - low) + 1)
    cost_cents = 40 * low + draw.below(60 * high - 40 * low + 1)
    category, brand = draw.one_of(tuple(PRICE_RANGES)), draw.one_of(BRANDS)
    return (
        ids.withColumn("category", category)
        .withColumn("_range", F.element_at(ranges, F.col("category")))
        .select(
            padded_key("P", F.col("id"), 4).alias("product_id"),
            F.concat("category", F.lit(" Item "), F.col("id")).alias("name"),
            "category",
            brand.alias("brand"),
            (price_cents / 100.0).alias("price"),
            (cost_cents / 100.0).alias("cost"),
            draw.below(501).alias("stock_qty"),
            ((30 + draw.below(21)) / 10.0).alias("rating"),
        )
    )


def orders(
    ids: DataFrame,
    n: int | Column,
    end: dt.datetime,
    customer_count: int | Column = CUSTOMERS,
    product_count: int | Column = PRODUCTS,
    seed: int = 42,
) -> DataFrame:
    """Order rows; the amount is quantity times unit price, exact to the cent."""
    draw = _Draws(seed, "orders")
    quantity, price_cents = 1 + draw.below(5), 500 + draw.below(149_501)
    return ids.withColumns({"_quantity": quantity, "_cents": price_cents}).select(
        padded_key("O", F.col("id"), 7).alias("order_id"),
        padded_key("C", 1 + draw.below(customer_count), 5).alias("customer_id"),
        padded_key("P", 1 + draw.below(product_count), 4).alias("product_id"),
        F.col("_quantity").cast("int").alias("quantity"),
        (F.col("_cents") / 100.0).alias("unit_price"),
        (F.col("_quantity") * F.col("_cents") / 100.0).alias("total_amount"),
        draw.weighted(STATUS_WEIGHTS).alias("status"),
        _clock(n, end).alias("order_date"),
        draw.weighted(COUNTRY_WEIGHTS).alias("ship_country"),
    )


def clicks(
    ids: DataFrame,
    n: int | Column,
    end: dt.datetime,
    customer_count: int | Column = CUSTOMERS,
    product_count: int | Column = PRODUCTS,
    session_count: int | Column = SESSIONS,
    seed: int = 42,
) -> DataFrame:
    """Click rows; some draws fall outside the products and leave the product empty."""
    draw = _Draws(seed, "clicks")
    product = 1 + draw.below(product_count + NO_PRODUCT_DRAWS)
    return ids.withColumn("_product", product).select(
        padded_key("E", F.col("id"), 8).alias("event_id"),
        padded_key("C", 1 + draw.below(customer_count), 5).alias("customer_id"),
        F.when(F.col("_product") <= product_count, padded_key("P", F.col("_product"), 4)).alias("product_id"),
        draw.one_of(EVENT_TYPES).alias("event_type"),
        padded_key("S", 1 + draw.below(session_count), 6).alias("session_id"),
        draw.one_of(DEVICES).alias("device"),
        _clock(n, end).alias("ts"),
    )
