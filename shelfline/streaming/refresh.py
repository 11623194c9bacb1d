"""The refresh run: landing files to bronze, silver and gold, in a fixed order.

An incremental run reads only files that are new since the last one. Checked rows, rejected rows and the counts of
a micro-batch come from one scan of it. The gold views are carried on from new batches: daily revenue by the months that
have grown, sessions, products and customers by the hash buckets that new rows fall in. A full run starts a new
generation, with new checkpoints and new tables, beside the old one, which readers keep using
until the new generation is complete.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from shelfline import schemas
from shelfline.operators import quality
from shelfline.operators.quality import CLICK_CHECKS, ORDER_CHECKS
from shelfline.plans import gold, silver
from shelfline.plans.questions import ORDER_MONTH, with_order_month
from shelfline.session import clean_up_shuffles
from shelfline.sources import tables
from shelfline.sources.batches import BatchTable
from shelfline.sources.buckets import BucketState
from shelfline.sources.landing import remembered_schema
from shelfline.streaming.changes import ChangeTable
from shelfline.streaming.ingest import append_stream, batch_stream, bronze_stream, csv_records, table_stream, wait


@dataclass(frozen=True)
class Feed:
    """A landing folder, the bronze table it fills, and its schema where none is inferred."""

    folder: str
    fmt: str
    table: str
    declared: str
    provenance: bool = False


FEEDS = (
    Feed("orders", "csv", "bronze_orders", schemas.ORDERS, provenance=True),
    Feed("products", "json", "bronze_products", schemas.PRODUCTS, provenance=True),
    Feed("clickstream", "json", "bronze_clickstream", schemas.CLICKS),
    Feed("customers", "parquet", "bronze_customers_cdc", schemas.CUSTOMER_CHANGES),
)

# How many gold views are made side by side.
VIEWS_AT_ONCE = 2
# How many micro-batches of customer changes are kept apart before they are folded into one.
FOLD_EVERY = 64

# The layer of each table.
QUALITY = {
    **{feed.table: "bronze" for feed in FEEDS},
    "silver_orders": "silver",
    "silver_orders_rejects": "silver",
    "silver_products": "silver",
    "silver_clickstream": "silver",
    "silver_clickstream_rejects": "silver",
    "silver_customers": "silver",
    "silver_checks": "silver",
    "gold_revenue_daily": "gold",
    "gold_top_products": "gold",
    "gold_cart_abandonment": "gold",
    "gold_customer_ltv": "gold",
}


# Tables of micro-batches in numbered folders.
BATCHED = (
    "bronze_orders",
    "silver_orders",
    "silver_orders_rejects",
    "silver_clickstream",
    "silver_clickstream_rejects",
)
# Views that are kept in hash buckets, and the key they are dealt by.
BUCKETED = {
    "gold_top_products": ["product_id"],
    "gold_cart_abandonment": gold.SESSION_KEYS,
    "gold_customer_ltv": ["customer_id"],
}


class Store:
    """Tables of one generation below a root folder."""

    def __init__(self, spark: SparkSession, root: str, generation: str):
        self.spark = spark
        self.path = f"{root}/{generation}"

    def table(self, name: str) -> str:
        layer = QUALITY[name.removesuffix("_progress")]
        return f"{self.path}/{layer}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.path}/checkpoints/{name}"

    def customers(self) -> ChangeTable:
        return ChangeTable(self.spark, self.table("silver_customers"))

    def batches(self, name: str) -> BatchTable:
        return BatchTable(self.spark, self.table(name))

    def checks(self, name: str) -> BatchTable:
        """The counts of a checked table, a batch for each of its own."""
        return BatchTable(self.spark, f"{self.table('silver_checks')}/{name}")

    def state(self, name: str) -> BucketState:
        return BucketState(self.spark, f"{self.table(name)}_state", BUCKETED[name])

    def read(self, name: str) -> DataFrame:
        """Snapshot of a table."""
        if name == "silver_customers":
            return self.customers().current()
        if name == "silver_checks":
            lines = [self.checks(n).read() for n in ("silver_orders", "silver_clickstream")]
            return quality.added_up(lines[0].unionByName(lines[1]))
        if name == "gold_cart_abandonment":
            return gold.session_view(self.state(name).read("sessions"))
        if name in BATCHED:
            # Kept rows have no reasons; the column comes from the one write of both kinds.
            rows = self.batches(name).read()
            return rows if name.endswith("_rejects") else rows.drop("reasons")
        if QUALITY[name] == "gold" or name == "silver_products":
            return tables.read_latest(self.spark, self.table(name))
        return self.spark.read.parquet(self.table(name))

    def create_views(self) -> list[str]:
        """Temporary views with the tables' names, for queries written in SQL."""
        for name in QUALITY:
            self.read(name).createOrReplaceTempView(name)
        return list(QUALITY)


def _generations(spark: SparkSession, root: str) -> list[str]:
    return [g for g in tables.folders(spark, root) if g.startswith("g")]


def open_store(spark: SparkSession, root: str) -> Store:
    """The newest complete generation."""
    complete = [g for g in _generations(spark, root) if tables.exists(spark, f"{root}/{g}/{tables.READY}")]
    if not complete:
        raise FileNotFoundError(f"nothing has been refreshed under {root}")
    return Store(spark, root, complete[-1])


def start_bronze(
    store: Store,
    landing: str,
    feed: Feed,
    max_bytes: int | None = None,
    every: str | None = None,
    infer: bool = True,
) -> StreamingQuery:
    """Append the new files of one feed to its bronze table."""
    source = f"{landing}/{feed.folder}"
    schema = StructType.fromDDL(feed.declared)
    if infer:
        schema = remembered_schema(
            store.spark, f"{store.path}/schemas/{feed.folder}", source, feed.fmt, declared=schema
        )
    rows = bronze_stream(store.spark, source, feed.fmt, schema, feed.provenance, max_bytes)
    if feed.fmt == "csv":
        bronze = store.batches(feed.table)

        def write(lines: DataFrame, number: int) -> None:
            if not bronze.holds(number):
                bronze.write(csv_records(lines, schema), number)

        return batch_stream(rows, write, store.checkpoint(feed.table), every)
    return append_stream(rows, store.table(feed.table), store.checkpoint(feed.table), every=every)


def checked(
    store: Store, name: str, typed: Callable[[DataFrame], DataFrame], checks: Sequence[quality.Expectation]
) -> Callable[[DataFrame, int], None]:
    """The writer of a checked table: rows that are kept, rows that are rejected with reasons, and the counts of the batch.

    A batch is scanned once. Its rows are written in one job, apart by whether they are kept, with the
    counts observed on the way; then each table takes its folder. The counts are stored first, so a batch that was
    stopped in between is done again as a whole and never counted twice.
    """
    kept, rejected, counts = store.batches(name), store.batches(f"{name}_rejects"), store.checks(name)
    done = BatchTable(store.spark, f"{kept.root}_done")

    def write(batch: DataFrame, number: int) -> None:
        if done.holds(number):
            return
        rows = typed(batch)
        kept.declare(rows)
        rejected.declare(rows.withColumn("reasons", quality.reasons(checks)))
        seen = Observation(name)
        marked = quality.observed(rows, seen, checks).withColumn("reasons", quality.reasons(checks))
        marked = marked.withColumn("_kept", F.size("reasons") == 0)
        by = ["_kept", *([ORDER_MONTH] if ORDER_MONTH in rows.columns else [])]
        staged = kept.staging(number)
        marked.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(staged, compression=tables.COMPRESSION)
        lines = quality.metric_lines(seen.get, name, checks)
        counts.write(store.spark.createDataFrame(lines, quality.METRICS).coalesce(1), number)
        kept.adopt(f"{staged}/_kept=true", number)
        rejected.adopt(f"{staged}/_kept=false", number)
        tables.mark(store.spark, done.folder(number))
        tables.remove(store.spark, staged)

    return write


def start_silver(store: Store, every: str | None = None) -> dict[str, StreamingQuery]:
    """The silver streams: checked orders and clicks with the rows that were dropped, customer changes.

    Without ``every`` each takes what its bronze table holds and ends; with it they run on.
    """
    writers = {
        "silver_orders": (
            "bronze_orders",
            checked(store, "silver_orders", lambda rows: with_order_month(silver.typed_orders(rows)), ORDER_CHECKS),
        ),
        "silver_clickstream": (
            "bronze_clickstream",
            checked(store, "silver_clickstream", silver.typed_clicks, CLICK_CHECKS),
        ),
        "silver_customers": ("bronze_customers_cdc", store.customers().writer(fold_every=FOLD_EVERY)),
    }
    return {
        name: batch_stream(table_stream(store.spark, store.table(bronze)), write, store.checkpoint(name), every)
        for name, (bronze, write) in writers.items()
    }


def start_continuous(store: Store, landing: str, every: str) -> list[StreamingQuery]:
    """Bronze and silver streams of a store that has been refreshed once, running on an interval.

    Views are not streams: call :func:`refresh_views` as often as they should follow.
    """
    clean_up_shuffles(store.spark)
    bronze = [start_bronze(store, landing, feed, every=every) for feed in FEEDS]
    return bronze + list(start_silver(store, every).values())


def _in_months(column: Column, months: list[dt.date | None]) -> Column:
    known = [month for month in months if month is not None]
    found = column.isin(known) if known else F.lit(False)
    return found | column.isNull() if None in months else found


def _rows_by_month(orders: DataFrame) -> DataFrame:
    """Row counts of the stored months, which the scan takes from the files' footers."""
    return orders.groupBy(ORDER_MONTH).agg(F.count(F.lit(1)).alias("rows"))


def changed_months(store: Store, orders: DataFrame) -> list[dt.date | None] | None:
    """Months that have grown since the daily revenue was last computed; None before that.

    Orders are only ever appended, so a month has changed when its row count has. One value per
    calendar month comes back.
    """
    progress = store.table("gold_revenue_daily_progress")
    if not tables.versions(store.spark, progress):
        return None
    grown = _rows_by_month(orders).subtract(tables.read_latest(store.spark, progress))
    return [row[0] for row in grown.select(ORDER_MONTH).collect()]


def refresh_daily_revenue(store: Store, orders: DataFrame) -> DataFrame:
    """Daily revenue, computed again for the months that new orders fall in and kept for the others.

    The progress is stored after the view, so a run that dies in between computes a month twice
    and never misses one.
    """
    path = store.table("gold_revenue_daily")
    months = changed_months(store, orders)
    if months == []:
        return tables.read_latest(store.spark, path)
    if months is None:
        view = gold.gold_revenue_daily(orders)
    else:
        again = F.coalesce(_in_months(F.trunc("order_day", "month"), months), F.lit(False))
        kept = tables.read_latest(store.spark, path).filter(~again)
        view = kept.unionByName(gold.gold_revenue_daily(orders.filter(_in_months(F.col(ORDER_MONTH), months))))
    stored = tables.write_version(view, path)
    tables.write_version(_rows_by_month(orders), store.table("gold_revenue_daily_progress"))
    return stored


def _carry_on(
    store: Store,
    name: str,
    rows: BatchTable,
    parts: Callable[[DataFrame], DataFrame],
    merge: Callable[[DataFrame], DataFrame],
    part: str,
    month: str | None = None,
    totals: Callable[[DataFrame], DataFrame] | None = None,
) -> list[int]:
    """Bring the state of a view up to its source: new batches are merged into the buckets they touch.

    Their rows, each a part of its own, are added up once, together with the stored parts. The buckets are told from
    the keys alone.

    ``totals`` are made again for the touched buckets only, from the part just written. Readers take a view that is made of
    them, never such a state, so the buckets it has replaced are deleted.
    """
    state, numbers = store.state(name), rows.numbers()
    upto = state.upto()
    if not numbers or numbers[-1] <= upto:
        return []
    source = rows.read(after=upto, upto=numbers[-1])
    new, touched = parts(source), state.touched(source)
    old = state.read(part, touched)
    change = state.start()
    if month:
        old = None if old is None else old.drop(month)
    merged = merge(new if old is None else old.unionByName(new))
    merged = gold.with_session_month(merged) if month else merged
    written = state.write(change, part, merged, month)
    if totals:
        state.write(change, "totals", totals(written))
    state.commit(change, touched, numbers[-1])
    if totals:
        state.drop_unused(keep=1)
    return touched


def refresh_sessions(store: Store) -> list[int]:
    """Merge new clicks into the sessions; returns the buckets that were rewritten."""
    clicks = store.batches("silver_clickstream")
    return _carry_on(
        store,
        "gold_cart_abandonment",
        clicks,
        gold.session_clicks,
        gold.merged_sessions,
        "sessions",
        month=gold.SESSION_MONTH,
    )


def refresh_product_totals(store: Store) -> list[int]:
    """Add new order lines to the product totals; an order that is delivered again is counted once."""
    orders = store.batches("silver_orders")
    return _carry_on(
        store,
        "gold_top_products",
        orders,
        gold.product_lines,
        gold.added_product_orders,
        "orders",
        totals=gold.product_totals,
    )


def refresh_customer_totals(store: Store) -> list[int]:
    """Add new order lines to the customer totals; an order that is delivered again is counted once."""
    orders = store.batches("silver_orders")
    return _carry_on(
        store,
        "gold_customer_ltv",
        orders,
        gold.customer_lines,
        gold.added_customer_orders,
        "orders",
        totals=gold.customer_totals,
    )


def _totals(store: Store, name: str, none: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stored totals of a view, or its columns without rows where no order has come yet."""
    found = store.state(name).read("totals")
    return none(store.read("silver_orders")) if found is None else found


def refresh_views(store: Store, as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """Refresh the product view and the gold views from the silver snapshots.

    Daily revenue is computed again for the months that changed. Sessions, product totals and customer totals are
    carried on in the hash buckets that new rows fall in; products and customers are joined with the totals, a row each.

    The gold views do not depend on each other, so the jobs of two are submitted together and share
    the cluster; more at once would hold more shuffle files on disk.
    """
    store.customers().fold()
    products = silver.silver_products(store.read("bronze_products"))
    products = tables.write_version(products, store.table("silver_products"))

    def sessions() -> DataFrame:
        refresh_sessions(store)
        return store.read("gold_cart_abandonment")

    def top_products() -> DataFrame:
        refresh_product_totals(store)
        sold = _totals(store, "gold_top_products", lambda rows: gold.product_totals(gold.product_orders(rows)))
        return tables.write_version(gold.described_products(sold, products), store.table("gold_top_products"))

    def customer_ltv() -> DataFrame:
        refresh_customer_totals(store)
        bought = _totals(store, "gold_customer_ltv", lambda rows: gold.customer_totals(gold.customer_orders(rows)))
        view = gold.valued_customers(store.read("silver_customers"), bought, as_of)
        return tables.write_version(view, store.table("gold_customer_ltv"))

    views = {
        "gold_revenue_daily": lambda: refresh_daily_revenue(store, store.read("silver_orders")),
        "gold_top_products": top_products,
        "gold_cart_abandonment": sessions,
        "gold_customer_ltv": customer_ltv,
    }
    with ThreadPoolExecutor(VIEWS_AT_ONCE) as pool:
        written = {name: pool.submit(view) for name, view in views.items()}
        return {name: done.result() for name, done in written.items()}


def refresh(
    spark: SparkSession,
    landing: str,
    root: str,
    as_of: dt.date | None = None,
    full: bool = False,
    max_bytes: int | None = None,
    infer: bool = True,
) -> Store:
    """Bring all tables below ``root`` up to date with the files below ``landing``.

    The first run of a generation infers the schemas, which reads the text feeds once more;
    ``infer=False`` takes the declared ones instead.
    """
    clean_up_shuffles(spark)
    known = _generations(spark, root)
    number = int(known[-1][1:]) if known else 0
    if full or not known:
        number += 1
    store = Store(spark, root, f"g{number:06d}")
    with ThreadPoolExecutor(len(FEEDS)) as pool:
        wait(list(pool.map(lambda feed: start_bronze(store, landing, feed, max_bytes, infer=infer), FEEDS)))
    wait(start_silver(store).values())
    refresh_views(store, as_of)
    tables.mark(spark, store.path)
    return store


# In how many parts, by hash, the rows of two tables are first compared.
PARTS = 4096


def _sides(first: Store, second: Store, name: str, leave_out: Sequence[str]) -> DataFrame:
    """The row hashes of a table in two generations, with a step of 1 and -1."""
    tables_of = [store.read(name) for store in (first, second)]
    both = set(tables_of[0].columns) & set(tables_of[1].columns)
    columns = sorted(both - {"_ingestion_ts", *leave_out})
    sides = [
        rows.select(F.xxhash64(*columns).alias("row"), F.lit(step).alias("step"))
        for rows, step in zip(tables_of, (1, -1))
    ]
    return sides[0].unionByName(sides[1]).withColumn("part", F.pmod("row", F.lit(PARTS)))


def unlike_parts(sides: DataFrame) -> DataFrame:
    """Parts in which the hashes of the two sides differ in their number or in the sum of one of their halves."""
    row, step = F.col("row"), F.col("step")
    halves = [F.sum(F.shiftright(row, 32) * step).alias("high"), F.sum(row.bitwiseAND(F.lit(0xFFFFFFFF)) * step).alias("low")]
    counted = sides.groupBy("part").agg(F.sum(step).alias("more"), *halves)
    return counted.filter("more <> 0 OR high <> 0 OR low <> 0").select("part")


def generation_difference(first: Store, second: Store, leave_out: Sequence[str] = ()) -> DataFrame:
    """Rows of each table that one generation has more often than the other, as counts; clocks and columns of one only are left out.

    Both are compared as multisets of row hashes: first by parts, then row by row in the parts that differ, so
    only rows of those are shuffled. The list of parts is bounded and sent to the rows.
    """
    lines = None
    for name in QUALITY:
        sides = _sides(first, second, name, leave_out)
        looked_into = sides.join(F.broadcast(unlike_parts(sides)), "part", "left_semi")
        more = looked_into.groupBy("row").agg(F.sum("step").alias("more"))
        line = more.agg(
            F.coalesce(F.sum(F.greatest("more", F.lit(0))), F.lit(0)).alias("only_first"),
            F.coalesce(F.sum(F.greatest(-F.col("more"), F.lit(0))), F.lit(0)).alias("only_second"),
        ).select(F.lit(name).alias("table_name"), "only_first", "only_second")
        lines = line if lines is None else lines.unionByName(line)
    return lines
