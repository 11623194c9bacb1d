"""Silver datasets: typed, checked, one row per key where the dataset has a key.

Each is a function of the bronze rows. Orders and clicks are row-wise, so the same function body
serves a batch and a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from shelfline.operators.dates import read_time
from shelfline.operators.money import addable
from shelfline.operators.newest import newest_per_key
from shelfline.operators.quality import CLICK_CHECKS, ORDER_CHECKS, enforce, observed


def _typed(name: str, kind: str) -> Column:
    """Cast that turns what cannot be read, or is no number that can be added, into NULL, which the checks see."""
    value = F.col(name).try_cast(kind)
    return (addable(value) if kind == "double" else value).alias(name)


def _time(bronze: DataFrame, name: str) -> Column:
    """A time column as it is, or read from text in any of the known spellings."""
    return F.col(name) if bronze.schema[name].dataType == TimestampType() else read_time(F.col(name))


def typed_orders(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "order_id",
        "customer_id",
        "product_id",
        _typed("quantity", "int"),
        _typed("unit_price", "double"),
        _typed("total_amount", "double"),
        "status",
        _time(bronze, "order_date").alias("order_date"),
        "ship_country",
        "_ingestion_ts",
    )


def silver_orders(bronze: DataFrame, observe_as: str | None = None) -> DataFrame:
    rows = typed_orders(bronze)
    if observe_as:
        rows = observed(rows, observe_as, ORDER_CHECKS)
    return enforce(rows, ORDER_CHECKS)


def typed_clicks(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "event_id",
        "customer_id",
        "product_id",
        "event_type",
        "session_id",
        "device",
        _time(bronze, "ts").alias("event_ts"),
        "_ingestion_ts",
    )


def silver_clickstream(bronze: DataFrame, observe_as: str | None = None) -> DataFrame:
    rows = typed_clicks(bronze)
    if observe_as:
        rows = observed(rows, observe_as, CLICK_CHECKS)
    return enforce(rows, CLICK_CHECKS)


def silver_products(bronze: DataFrame) -> DataFrame:
    """Newest delivery of each product, with its margin in percent of the price.

    Rows that were ingested together are told apart by the time of their files, where bronze keeps it.
    """
    clocks = [F.col(c) for c in ("_ingestion_ts", "_source_ts", "_source_file") if c in bronze.columns]
    margin = (F.col("price") - F.col("cost")) / F.nullif("price", F.lit(0)) * 100
    return (
        newest_per_key(bronze, ["product_id"], clocks)
        .select(
            "product_id",
            F.col("name").alias("product_name"),
            "category",
            "brand",
            _typed("price", "double"),
            _typed("cost", "double"),
            _typed("stock_qty", "int"),
            _typed("rating", "double"),
        )
        .withColumn("margin_pct", F.round(margin, 2))
    )


CHANGE_KEYS = ["customer_id"]
CHANGE_COLUMNS = ("_change_type", "_commit_version", "_ingestion_ts")


def newest_change(changes: DataFrame) -> DataFrame:
    """The change that decides each customer, deletes included as tombstones.

    The highest commit version wins whatever order the changes arrived in; a delete beats another
    change of the same version. The ingestion clock is left out: it differs between two reads of
    one file and must not decide anything.
    """
    is_delete = F.coalesce(F.col("_change_type") == "delete", F.lit(False))
    return newest_per_key(changes.drop("_ingestion_ts"), CHANGE_KEYS, [F.col("_commit_version"), is_delete])


def without_tombstones(newest: DataFrame) -> DataFrame:
    """Current customers from the newest change of each."""
    kept = ~F.coalesce(F.col("_change_type") == "delete", F.lit(False))
    return newest.filter(kept).drop(*CHANGE_COLUMNS)


def silver_customers(changes: DataFrame) -> DataFrame:
    """Current customers after all changes."""
    return without_tombstones(newest_change(changes))
