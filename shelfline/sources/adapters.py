"""The given star-schema tables in the shape of the raw feeds.

``orders ⋈ customer ⋈ nation`` is built first and then joined with ``lineitem`` once. No side is
broadcast by hint: Spark broadcasts a side whose size it knows to be below its threshold, and
adaptive execution splits the partition of a hot order or customer key in the other case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.scalars import padded_key

ORDER_WIDTH, CUSTOMER_WIDTH, PRODUCT_WIDTH, EVENT_WIDTH = 7, 5, 4, 8
CLOCK = "2024-02-01 00:00:00"


class Tables:
    """The given Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def _cents(amount: Column) -> Column:
    return F.floor(amount * 100 + 0.5) / 100.0


def customer_key(column: str) -> Column:
    return padded_key("C", F.col(column), CUSTOMER_WIDTH)


def product_key(column: Column) -> Column:
    return padded_key("P", column, PRODUCT_WIDTH)


def orders_feed(tables: Tables) -> DataFrame:
    """Order lines with status, amount and shipping country."""
    countries = tables.read("nation").select("n_nationkey", F.col("n_name").alias("ship_country"))
    buyers = tables.read("customer").select("c_custkey", "c_nationkey")
    heads = (
        tables.read("orders")
        .select("o_orderkey", "o_custkey", "o_orderdate")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .join(countries, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_custkey", "o_orderdate", "ship_country")
    )
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    status = (
        F.when((flag == "R") & (line == "F"), "returned")
        .when((flag == "A") & (line == "F"), "cancelled")
        .when((flag == "N") & (line == "O"), "pending")
        .otherwise("completed")
    )
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return (
        tables.read("lineitem")
        .join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            padded_key("O", F.col("l_orderkey"), ORDER_WIDTH).alias("order_id"),
            customer_key("o_custkey").alias("customer_id"),
            product_key(F.col("l_partkey")).alias("product_id"),
            quantity.cast("int").alias("quantity"),
            _cents(price / quantity).alias("unit_price"),
            _cents(price * (1 - F.col("l_discount"))).alias("total_amount"),
            status.alias("status"),
            F.col("o_orderdate").cast("timestamp").alias("order_date"),
            "ship_country",
        )
    )


def refund_feed(tables: Tables) -> DataFrame:
    """The order feed as a careless exporter writes it, for the data-quality queries.

    Returned lines are booked as negative amounts, cancelled ones lose their customer, and the
    status of pending lines is misspelt.
    """
    status = F.col("status")
    return orders_feed(tables).withColumns(
        {
            "total_amount": F.when(status == "returned", -F.col("total_amount")).otherwise(F.col("total_amount")),
            "customer_id": F.when(status != "cancelled", F.col("customer_id")),
            "status": F.when(status == "pending", "Pending").otherwise(status),
        }
    )


def with_careless_rows(orders: DataFrame) -> DataFrame:
    """Orders as landed by a careless exporter: returned lines stand once more as negative amounts, cancelled ones once
    more without their customer."""
    status = F.col("status")
    kinds = F.when(status == "returned", F.array(F.lit(0), F.lit(1))).when(status == "cancelled", F.array(F.lit(0), F.lit(2)))
    rows = orders.withColumn("_kind", F.explode(F.coalesce(kinds, F.array(F.lit(0)))))
    amount, customer, kind = F.col("total_amount"), F.col("customer_id"), F.col("_kind")
    changed = {"total_amount": F.when(kind == 1, -amount).otherwise(amount), "customer_id": F.when(kind != 2, customer)}
    return rows.withColumns(changed).drop("_kind")


def with_unnamed_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks with every error event once more, without its id."""
    ids = F.when(F.col("event_type") == "error", F.array(F.col("event_id"), F.lit(None).cast("string")))
    return clicks.withColumn("event_id", F.explode(F.coalesce(ids, F.array("event_id"))))


def products_feed(tables: Tables) -> DataFrame:
    """Two deliveries of the catalog: every product at an old price, small ones again at today's."""
    price, size, key = F.col("p_retailprice"), F.col("p_size"), F.col("p_partkey")
    deliveries = F.array(
        F.struct(F.lit(1).alias("delivery"), _cents(price * 1.1).alias("price")),
        F.when(size <= 25, F.struct(F.lit(2).alias("delivery"), price.alias("price"))),
    )
    return (
        tables.read("part")
        .withColumn("_d", F.explode(F.array_compact(deliveries)))
        .select(
            product_key(key).alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.col("_d.price").alias("price"),
            _cents(price * (30 + size * 1.6) / 100).alias("cost"),
            (key * 37 % 501).cast("bigint").alias("stock_qty"),
            (F.lit(3.0) + (key % 21) / 10.0).alias("rating"),
            F.col("_d.delivery").alias("_delivery"),
        )
    )


def clicks_feed(tables: Tables) -> DataFrame:
    """Click events; errors have no product and a type outside the domain."""
    kind = F.col("event_type")
    page = (
        F.when(kind == "view", "view_product")
        .when(kind == "click", "add_to_cart")
        .when(kind == "signup", "home_page")
        .otherwise(kind)
    )
    device = F.element_at(
        F.array(F.lit("mobile"), F.lit("desktop"), F.lit("tablet")), (F.col("user_id") % 3 + 1).cast("int")
    )
    product = F.get_json_object("props", "$.k").cast("bigint")
    return tables.read("events").select(
        padded_key("E", F.col("event_id"), EVENT_WIDTH).alias("event_id"),
        customer_key("user_id").alias("customer_id"),
        F.when(kind.isin("view", "click", "purchase"), product_key(product)).alias("product_id"),
        page.alias("event_type"),
        F.concat(F.lit("S"), F.col("user_id"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        device.alias("device"),
        F.date_trunc("second", "ts").alias("ts"),
    )


def customer_changes(tables: Tables) -> DataFrame:
    """Customer change feed with ``_arrival``, the delivery each change comes in.

    All customers are inserted; rich ones are moved to Premium, indebted ones become inactive and
    the deepest in debt are deleted. For the deleted ones an older update arrives last of all.
    """
    countries = tables.read("nation").select("n_nationkey", F.col("n_name").alias("country"))
    key, balance, market = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_mktsegment")
    segment = (
        F.when(market == "AUTOMOBILE", "Premium").when(market.isin("BUILDING", "FURNITURE"), "Standard").otherwise("Budget")
    )

    def change(kind: str, version: int, arrival: int, segment: Column, active: bool) -> Column:
        return F.struct(
            F.lit(kind).alias("_change_type"),
            F.lit(version).cast("bigint").alias("_commit_version"),
            F.lit(arrival).alias("_arrival"),
            segment.alias("segment"),
            F.lit(active).alias("is_active"),
        )

    changes = F.array_compact(
        F.array(
            change("insert", 1, 1, segment, True),
            F.when(balance > 8000, change("update", 2, 1, F.lit("Premium"), True)),
            F.when(balance < 0, change("update", 3, 2, segment, False)),
            F.when(balance < -900, change("delete", 4, 2, segment, False)),
            F.when(balance < -900, change("update", 2, 3, F.lit("Premium"), True)),
        )
    )
    return (
        tables.read("customer")
        .join(countries, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("_c", F.explode(changes))
        .select(
            customer_key("c_custkey").alias("customer_id"),
            F.substring_index("c_name", "#", 1).alias("first_name"),
            F.substring_index("c_name", "#", -1).alias("last_name"),
            F.concat(F.lit("user"), key, F.lit("@mail.example.com")).alias("email"),
            "country",
            F.col("_c.segment").alias("segment"),
            F.date_format(F.date_add(F.lit("1994-01-01").cast("date"), (key % 365).cast("int")), "yyyy-MM-dd").alias(
                "signup_date"
            ),
            F.col("_c.is_active").alias("is_active"),
            F.col("_c._change_type").alias("_change_type"),
            F.col("_c._commit_version").alias("_commit_version"),
            F.col("_c._arrival").alias("_arrival"),
        )
    )


def bronze(feed: DataFrame) -> DataFrame:
    """A feed as if ingested in one go: helper columns off, a fixed ingestion clock on.

    Products were delivered twice, so their clock runs on by one hour per delivery.
    """
    clock = F.lit(CLOCK).cast("timestamp")
    if "_delivery" in feed.columns:
        clock = clock + F.make_dt_interval(hours=F.col("_delivery"))
    return feed.withColumn("_ingestion_ts", clock).drop("_delivery", "_arrival")


def conversation_turns(tables: Tables) -> DataFrame:
    return tables.read("conversations").select("conv_id", "turn", "role", F.col("text").alias("content"))
