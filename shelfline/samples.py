"""Landing files: the seeded sample feeds, and the given tables; sample feeds of the tables' sizes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.schemas import TIME_FORMAT
from shelfline.sources import adapters, generate, landing
from shelfline.sources.adapters import Tables
from shelfline.streaming.refresh import Store, refresh, refresh_views, start_continuous
from shelfline.warehouse import Warehouse

SAMPLE_END = dt.datetime(2025, 1, 1)


def land_sample_feeds(
    spark: SparkSession,
    folder: str,
    customers: int = generate.CUSTOMERS,
    products: int = generate.PRODUCTS,
    orders: int = generate.ORDERS,
    clicks: int = generate.CLICKS,
    sessions: int = generate.SESSIONS,
    end: dt.datetime | None = None,
    seed: int = 42,
) -> None:
    """Make the four sample feeds and land them, the orders in two batches by order id.

    Times run over the year up to ``end``, by default up to now.
    """
    end = end or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    order_ids = generate.ids(spark, orders)
    batches = landing.split_arrivals(order_ids, F.col("id"), orders // 2)
    for number, ids in enumerate(batches, start=1):
        rows = generate.orders(ids, orders, end, customers, products, seed)
        landing.write_csv(rows, f"{folder}/orders/batch{number}")
    landing.write_parquet(generate.customers(generate.ids(spark, customers), seed), f"{folder}/customers")
    landing.write_json(generate.products(generate.ids(spark, products), seed), f"{folder}/products")
    events = generate.clicks(generate.ids(spark, clicks), clicks, end, customers, products, sessions, seed)
    landing.write_json(events, f"{folder}/clickstream")


def _as_text(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.date_format(column, TIME_FORMAT))


def middle_order(source: Tables) -> Column:
    """The order id in the middle of the key range."""
    middle = F.call_function("div", F.max("o_orderkey"), F.lit(2))
    return source.read("orders").agg(adapters.padded_key("O", middle, adapters.ORDER_WIDTH)).scalar()


# The spelling of times in the second delivery of orders.
LATER_FORMAT = "dd.MM.yyyy HH:mm:ss"


def order_deliveries(orders: DataFrame, middle: Column) -> tuple[DataFrame, DataFrame]:
    """Raw order lines in two deliveries that share many orders.

    Beside good lines both hold lines to be rejected. The second has its columns in another order, a column
    more, and times in another spelling.
    """
    raw = adapters.with_careless_rows(orders)
    early = (F.col("order_id") <= middle) | (F.col("quantity") < 10)
    first, second = landing.split_arrivals(raw, F.when(early, 1).otherwise(2), 1)
    second = second.withColumn("order_date", F.date_format("order_date", LATER_FORMAT))
    channel = F.when(F.col("quantity") % 2 == 0, "web").otherwise("shop").alias("channel")
    return _as_text(first, "order_date"), second.select("ship_country", channel, *second.columns[:-1])


def click_deliveries(clicks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw clicks in two deliveries that share many sessions; the second has a field more."""
    raw = _as_text(adapters.with_unnamed_clicks(clicks), "ts")
    first, second = landing.split_arrivals(raw, F.substring("ts", 18, 2).cast("int") % 3, 1)
    return first, second.withColumn("page", F.struct(F.col("device").alias("kind"), F.length("session_id").alias("width")))


def product_deliveries(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The catalog's deliveries by number; the second has a field more."""
    later = products.filter("_delivery = 2").withColumn("shelf", F.col("stock_qty") % 7)
    return products.filter("_delivery = 1").drop("_delivery"), later.drop("_delivery")


def deliver(warehouse: Warehouse, landing_dir: str, number: int) -> None:
    """Land one of the two deliveries of every feed.

    The second delivery of customer changes holds deletes and, after them, older updates.
    """
    source = warehouse.source
    orders = warehouse.table("silver_orders").drop("_ingestion_ts", "order_month")
    changes = adapters.customer_changes(source)
    arrived = changes.filter("_arrival = 1" if number == 1 else "_arrival > 1").drop("_arrival")
    landing.write_csv(order_deliveries(orders, middle_order(source))[number - 1], f"{landing_dir}/orders/batch{number}")
    landing.write_json(product_deliveries(adapters.products_feed(source))[number - 1], f"{landing_dir}/products/batch{number}")
    landing.write_json(click_deliveries(adapters.clicks_feed(source))[number - 1], f"{landing_dir}/clickstream/batch{number}")
    landing.write_parquet(arrived, f"{landing_dir}/customers/batch{number}")


def deliver_and_refresh(warehouse: Warehouse, landing_dir: str, root: str, as_of: dt.date) -> Store:
    """Land every feed in two deliveries and refresh after each."""
    deliver(warehouse, landing_dir, 1)
    refresh(warehouse.source.spark, landing_dir, root, as_of)
    deliver(warehouse, landing_dir, 2)
    return refresh(warehouse.source.spark, landing_dir, root, as_of)


def deliver_and_run(warehouse: Warehouse, landing_dir: str, root: str, as_of: dt.date, every: str = "1 second") -> Store:
    """The second delivery is taken by streams that run on an interval; they are stopped when they have read all of it."""
    deliver(warehouse, landing_dir, 1)
    store = refresh(warehouse.source.spark, landing_dir, root, as_of)
    running = start_continuous(store, landing_dir, every)
    try:
        deliver(warehouse, landing_dir, 2)
        for query in running:  # bronze first, then what reads it
            query.processAllAvailable()
    finally:
        for query in running:
            query.stop()
    refresh_views(store, as_of)
    return store


def described_orders(bronze: DataFrame) -> DataFrame:
    """Bronze orders with the delivery their file came in, what lay beyond the schema, and whether the file's time is known."""
    return bronze.select(
        *[c for c in bronze.columns if not c.startswith("_")],
        F.regexp_extract("_source_file", r"/orders/(batch\d)/", 1).alias("delivery"),
        (F.col("_source_ts") <= F.col("_ingestion_ts")).alias("file_is_older"),
        F.col("_beyond").alias("beyond"),
    )


def _ids(source: Tables, table: str, key: str) -> DataFrame:
    return source.read(table).select((F.col(key) + 1).alias("id"))


def _rows(source: Tables, table: str) -> Column:
    return source.read(table).agg(F.count(F.lit(1))).scalar()


def generated_customers(source: Tables) -> DataFrame:
    return generate.customers(_ids(source, "customer", "c_custkey"))


def generated_products(source: Tables) -> DataFrame:
    return generate.products(_ids(source, "part", "p_partkey"))


def generated_orders(source: Tables) -> DataFrame:
    return generate.orders(
        _ids(source, "orders", "o_orderkey"),
        _rows(source, "orders"),
        SAMPLE_END,
        customer_count=_rows(source, "customer"),
        product_count=_rows(source, "part"),
    )


def generated_clicks(source: Tables) -> DataFrame:
    return generate.clicks(
        _ids(source, "events", "event_id"),
        _rows(source, "events"),
        SAMPLE_END,
        customer_count=_rows(source, "customer"),
        product_count=_rows(source, "part"),
        session_count=_rows(source, "orders"),
    )
