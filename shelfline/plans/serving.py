"""Publishing keyed snapshots of gold tables, and the queries that serve from the copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.scalars import as_count, as_dollars
from shelfline.operators import money
from shelfline.schemas import PUBLISHED_KEYS
from shelfline.sources import tables


class KeyViolation(ValueError):
    """A table to be published has rows without a key, or several rows of one key."""


def key_faults(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows lack a part of the key, how many keys occur more than once."""
    missing = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.count_if((F.col("_n") > 1) & ~missing).alias("duplicate_keys"),
    )


def publish(df: DataFrame, root: str, keys: Sequence[str]) -> DataFrame:
    """Store a full copy under a declared key. A copy that breaks its key never becomes visible."""

    def check(stored: DataFrame) -> None:
        faults = key_faults(stored, keys).first()
        if faults.null_keys or faults.duplicate_keys:
            raise KeyViolation(
                f"key ({', '.join(keys)}): {faults.null_keys} rows without key, "
                f"{faults.duplicate_keys} keys more than once"
            )

    return tables.write_version(df, root, check=check)


def publish_gold(gold: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Publish the gold tables that are served, each under its key."""
    return {name: publish(gold[name], f"{root}/{name}_synced", keys) for name, keys in PUBLISHED_KEYS.items()}


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], writers: int = 8) -> None:
    """Copy a published snapshot into a database table, over a bounded number of connections."""
    df.write.option("numPartitions", writers).option("batchsize", 10_000).option("truncate", True).jdbc(
        url, table, mode="overwrite", properties=properties
    )


def publish_status(name: str, source: DataFrame, copy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and checksum of the source and of its copy, and whether they agree.

    The checksum adds hashes of whole rows, so a copy with another value fails too; it does not depend on the order of the rows and both sides
    are read once, without a join.
    """

    def hashed(df: DataFrame, is_source: bool) -> DataFrame:
        return df.select(F.lit(is_source).alias("_source"), F.xxhash64(*source.columns).cast("decimal(20,0)").alias("_hash"))

    source_side = F.col("_source")
    same = (F.col("source_rows") == F.col("copy_rows")) & (F.col("source_checksum") == F.col("copy_checksum"))
    return (
        hashed(source, True)
        .unionByName(hashed(copy, False))
        .agg(
            F.count_if(source_side).alias("source_rows"),
            F.count_if(~source_side).alias("copy_rows"),
            F.sum(F.when(source_side, F.col("_hash")).otherwise(0)).alias("source_checksum"),
            F.sum(F.when(source_side, 0).otherwise(F.col("_hash"))).alias("copy_checksum"),
        )
        .select(
            F.lit(name).alias("table_name"),
            F.lit(",".join(keys)).alias("key_columns"),
            "source_rows",
            "copy_rows",
            "source_checksum",
            "copy_checksum",
            F.when(same.eqNullSafe(True) | (F.col("source_rows") + F.col("copy_rows") == 0), "ONLINE")
            .otherwise("FAILED")
            .alias("state"),
        )
    )


def stale_ranges(name: str, source: DataFrame, copy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Where a copy differs from its source: a row per differing range of keys, or one row that says ``ONLINE``.

    Keys are dealt by the hexadecimal MD5 of their text. Counts and checksums of both sides are compared for
    the ranges of one digit first, and for two digits within those that differ, so the second look reads little of
    a copy that is nearly right. ``first_key`` and ``last_key`` are the ends of a range in the order of the keys' text.
    """

    def dealt(df: DataFrame, side: int) -> DataFrame:
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
        row = F.xxhash64(*source.columns).cast("decimal(20,0)")
        place = F.md5(key.cast("binary"))
        return df.select(F.lit(side).alias("side"), key.alias("key"), F.substring(place, 1, 2).alias("range"), row.alias("hash"))

    def apart(rows: DataFrame, digits: int) -> DataFrame:
        sides = [F.col("side") == F.lit(side) for side in (0, 1)]
        sums = rows.groupBy(F.substring("range", 1, digits).alias("range")).agg(
            F.count_if(sides[0]).alias("source_rows"),
            F.count_if(sides[1]).alias("copy_rows"),
            *[F.sum(F.when(side, F.col("hash")).otherwise(0)).alias(f"sum_{i}") for i, side in enumerate(sides)],
            F.min("key").alias("first_key"),
            F.max("key").alias("last_key"),
        )
        return sums.filter("source_rows <> copy_rows OR sum_0 <> sum_1").drop("sum_0", "sum_1")

    both = dealt(source, 0).unionByName(dealt(copy, 1))
    # At most one value for each of the sixteen digits comes back.
    digits = [row[0] for row in apart(both, 1).select("range").collect()]
    line = [F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns")]
    if not digits:
        rows = both.agg(F.count_if(F.col("side") == 0).alias("source_rows"), F.count_if(F.col("side") == 1).alias("copy_rows"))
        nothing = [F.lit(None).cast("string").alias(c) for c in ("range", "first_key", "last_key")]
        return rows.select(*line, F.lit("ONLINE").alias("state"), nothing[0], "source_rows", "copy_rows", *nothing[1:])
    found = apart(both.filter(F.substring("range", 1, 1).isin(digits)), 2)
    return found.select(*line, F.lit("FAILED").alias("state"), "range", "source_rows", "copy_rows", "first_key", "last_key")


def published_tables(spark: SparkSession, root: str) -> list[str]:
    """Names of the copies that have a finished version."""
    return [n for n in tables.folders(spark, root) if tables.versions(spark, f"{root}/{n}")]


def kpi_totals(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.coalesce(money.total("total_revenue"), F.lit(0.0)).alias("revenue"),
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("orders"),
    )


def kpi_avg_ltv(ltv: DataFrame) -> DataFrame:
    """Mean value of the customers who have any, active or not."""
    return ltv.filter(F.col("lifetime_value") > 0).agg(money.rounded_mean("lifetime_value").alias("avg_ltv"))


def kpi_aov(daily: DataFrame) -> DataFrame:
    """Revenue divided by orders; 0 when there are none."""
    value = F.when(F.col("orders") != 0, F.col("revenue") / F.col("orders")).otherwise(0.0)
    return kpi_totals(daily).select(value.alias("aov"))


# The labels of the figures.
REVENUE_CARD, ORDERS_CARD, VALUE_CARD, LTV_CARD = (
    "Total Revenue",
    "Total Orders",
    "Avg Order Value",
    "Avg Customer LTV",
)


def kpi_cards(daily: DataFrame, ltv: DataFrame) -> DataFrame:
    """The four figures as display text."""
    numbers = kpi_totals(daily)
    value = F.when(F.col("orders") != 0, F.col("revenue") / F.col("orders")).otherwise(0.0)
    orders = numbers.select(
        F.inline(
            F.array(
                F.struct(F.lit(REVENUE_CARD).alias("label"), as_dollars(F.col("revenue"), 0).alias("value")),
                F.struct(F.lit(ORDERS_CARD).alias("label"), as_count(F.col("orders")).alias("value")),
                F.struct(F.lit(VALUE_CARD).alias("label"), as_dollars(value, 2).alias("value")),
            )
        )
    )
    customers = kpi_avg_ltv(ltv).select(
        F.lit(LTV_CARD).alias("label"),
        as_dollars(F.coalesce("avg_ltv", F.lit(0.0)), 2).alias("value"),
    )
    return orders.unionByName(customers)


def trend_of_last_days(daily: DataFrame, days: int = 30) -> DataFrame:
    """Revenue per day from ``days`` days before the last day in the table on."""
    last = daily.agg(F.max("order_day")).scalar()
    return (
        daily.filter(F.col("order_day") >= F.date_sub(last, days))
        .groupBy(F.col("order_day").alias("day"))
        .agg(money.total("total_revenue").alias("revenue"))
        .orderBy("day")
    )


def country_revenue(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy(F.col("ship_country").alias("country"))
        .agg(money.total("total_revenue").alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


def top_product_revenue(products: DataFrame, n: int = 10) -> DataFrame:
    return (
        products.orderBy(F.desc("total_revenue"), "product_id")
        .limit(n)
        .select(F.col("product_name").alias("name"), F.col("total_revenue").alias("revenue"))
    )


def segments(ltv: DataFrame) -> DataFrame:
    return (
        ltv.groupBy("segment")
        .agg(F.count(F.lit(1)).alias("count"), money.rounded_mean("lifetime_value").alias("avg_ltv"))
        .orderBy(F.desc("avg_ltv"))
    )
