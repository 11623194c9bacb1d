
from __future__ import annotations

import datetime as dt
import os
import sys
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries  # noqa: E402
from shelfline import samples  # noqa: E402
from shelfline.functions import governance, scalars, tools  # noqa: E402
from shelfline.operators import quality  # noqa: E402
from shelfline.plans import bi, conversations, gold, questions, serving, silver  # noqa: E402
from shelfline.schemas import PUBLISHED_KEYS  # noqa: E402
from shelfline.session import shared_dir  # noqa: E402
from shelfline.sources import adapters, tables  # noqa: E402
from shelfline.sources.adapters import Tables, bronze  # noqa: E402
from shelfline.streaming.ingest import BEYOND, CORRUPT  # noqa: E402
from shelfline.streaming.refresh import Store, generation_difference, refresh  # noqa: E402
from shelfline.warehouse import Warehouse  # noqa: E402

try:  # the pipeline operators stand or fall with their own subpackage
    from shelfline.llm import oracles as llm_oracles  # noqa: E402
    from shelfline.llm import queries as llm_queries  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("shelfline.llm", "shelfline.llm.queries", "shelfline.llm.oracles", "corpus_pipeline"):
        raise
    LLM_QUERIES, LLM_ORACLES = {}, {}
except ImportError:  # an emptied folder is a package without the modules
    LLM_QUERIES, LLM_ORACLES = {}, {}
else:
    LLM_QUERIES, LLM_ORACLES = llm_queries.QUERIES, llm_oracles.ORACLES

# The tables end on 2001-08-01 (orders) and 2024-01-30 (events); "today" is pinned beside that.
AS_OF = dt.date(2001, 8, 1)
MONTH_DAY = dt.date(2001, 7, 15)
CLICKS_AS_OF = dt.date(2024, 1, 31)

_SOURCES = ("nation", "customer", "part", "orders", "lineitem", "events")
_lock = threading.RLock()
_built: dict[tuple, object] = {}


def _once(kind: str, spark: SparkSession, sf_dir: str, make: Callable[[], object]):
    """Build once per session and state of the source files."""
    state = tuple(tables.fingerprint(spark, Tables(spark, sf_dir).path(name)) for name in _SOURCES)
    key = (kind, spark.sparkContext.applicationId, sf_dir, state)
    with _lock:
        if key not in _built:
            _built[key] = make()
        return _built[key]


def _warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return _once(
        "warehouse",
        spark,
        sf_dir,
        lambda: Warehouse(Tables(spark, sf_dir), shared_dir(spark, "warehouse"), AS_OF),
    )


def _landed(spark: SparkSession, sf_dir: str, kind: str, run: Callable[..., Store]) -> tuple[Store, str, str]:
    """A store filled from landed files, and the folders of both."""

    def make() -> tuple[Store, str, str]:
        folder, root = shared_dir(spark, "landing"), shared_dir(spark, kind)
        return run(_warehouse(spark, sf_dir), folder, root, AS_OF), folder, root

    return _once(kind, spark, sf_dir, make)


def _store(spark: SparkSession, sf_dir: str) -> Store:
    """The given tables landed as files in two deliveries, each followed by an incremental refresh."""
    return _landed(spark, sf_dir, "store", samples.deliver_and_refresh)[0]


def _interval_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checked orders where the second delivery was taken by streams that ran on an interval."""
    return _landed(spark, sf_dir, "interval", samples.deliver_and_run)[0].read("silver_orders").drop(*CLOCKS)


def _full_refresh_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generation that two deliveries made step by step against one that read both at once."""
    step_by_step, folder, root = _landed(spark, sf_dir, "store", samples.deliver_and_refresh)
    at_once = _once("full", spark, sf_dir, lambda: refresh(spark, folder, root, AS_OF, full=True))
    return generation_difference(step_by_step, at_once, leave_out=(BEYOND,))


def _published(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def make() -> dict[str, DataFrame]:
        return serving.publish_gold(_warehouse(spark, sf_dir).gold(), shared_dir(spark, "published"))

    return _once("published", spark, sf_dir, make)


def _from_tables(query: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(Tables(spark, sf_dir))


def _on(*names: str, query: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query over stored warehouse tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = _warehouse(spark, sf_dir)
        return query(*[warehouse.table(name) for name in names])

    return run


def _on_copy(*names: str, query: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query over published copies."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        copies = _published(spark, sf_dir)
        return query(*[copies[name] for name in names])

    return run


def _from_store(name: str, query: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query over a table that the streams have filled."""
    return lambda spark, sf_dir: query(_store(spark, sf_dir).read(name))


def _sql_tool(sql: str, as_of: dt.date) -> Callable[[SparkSession, str], DataFrame]:
    """A call of one of the SQL table functions over the stored gold tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tools.register(spark, _warehouse(spark, sf_dir).gold(), as_of)
        return spark.sql(sql)

    return run


def _without(*columns: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.drop(*columns)


CLOCKS = ("_ingestion_ts", questions.ORDER_MONTH, gold.SESSION_MONTH, CORRUPT)
DAILY, PRODUCTS, SESSIONS, LTV = (
    "gold_revenue_daily",
    "gold_top_products",
    "gold_cart_abandonment",
    "gold_customer_ltv",
)


def _dq(make: Callable[..., DataFrame]) -> Callable[[Tables], DataFrame]:
    def query(source: Tables) -> DataFrame:
        orders = silver.typed_orders(bronze(adapters.refund_feed(source)))
        clicks = silver.typed_clicks(bronze(adapters.clicks_feed(source)))
        return make(orders, clicks)

    return query


def _dq_metrics(orders: DataFrame, clicks: DataFrame) -> DataFrame:
    return quality.metrics(orders, "silver_orders", quality.ORDER_CHECKS).unionByName(
        quality.metrics(clicks, "silver_clickstream", quality.CLICK_CHECKS)
    )


def _dq_rejects(orders: DataFrame, clicks: DataFrame) -> DataFrame:
    rejected = quality.rejects(orders, quality.ORDER_CHECKS)
    return rejected.select(
        "order_id", "product_id", "status", "total_amount", F.array_join("reasons", ",").alias("reasons")
    )


def _memberships(source: Tables) -> DataFrame:
    """Every nation has an analyst, a steward who may see personal data, and an administrator."""
    roles = F.array(
        F.struct(F.lit("analyst").alias("role"), F.lit("analysts").alias("group")),
        F.struct(F.lit("steward").alias("role"), F.lit(governance.PII_GROUP).alias("group")),
        F.struct(F.lit("admin").alias("role"), F.lit(governance.ADMIN_GROUP).alias("group")),
    )
    return (
        source.read("nation")
        .select("n_name", F.inline(roles))
        .select(F.concat("role", F.lit("_"), "n_name").alias("principal"), "group")
    )


def _reader(spark: SparkSession, sf_dir: str, principal: str) -> governance.GovernedReader:
    policies = {
        "silver_customers": governance.Policy(masks={"email": scalars.mask_email}),
        "tagged_customers": governance.Policy(mask_by_tags=True),
        "silver_orders": governance.Policy(row_filter=lambda: governance.country_filter("NATION_7")),
    }
    return governance.GovernedReader(principal, _memberships(Tables(spark, sf_dir)), policies)


def _as_principals(table: str, policy: str, principals: tuple[str, ...], columns: tuple[str, ...]):
    """What each principal sees of a table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _warehouse(spark, sf_dir).table(table)
        seen = [
            _reader(spark, sf_dir, p).read(policy, rows).select(F.lit(p).alias("principal"), *columns)
            for p in principals
        ]
        first, *others = seen
        for other in others:
            first = first.unionByName(other)
        return first

    return run


def _sql_policy(table: str, principal: str, sql: str) -> Callable[[SparkSession, str], DataFrame]:
    """A query that calls the SQL policy functions as one principal."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _warehouse(spark, sf_dir).table(table).createOrReplaceTempView(table)
        _reader(spark, sf_dir, principal).register(spark, country="NATION_7")
        return spark.sql(sql)

    return run


def _principal_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the nations of one region, by a (principal, country) table."""
    source = Tables(spark, sf_dir)
    lookup = (
        source.read("nation")
        .join(source.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.concat(F.lit("region_"), "r_name").alias("principal"), F.col("n_name").alias("country"))
    )
    orders = _warehouse(spark, sf_dir).table("silver_orders").drop(*CLOCKS)
    return governance.rows_of_principal(orders, "ship_country", "region_ASIA", lookup)


def _publish_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, copies = _warehouse(spark, sf_dir), _published(spark, sf_dir)
    status = None
    for name, keys in PUBLISHED_KEYS.items():
        line = serving.publish_status(name, warehouse.table(name), copies[name], keys)
        status = line if status is None else status.unionByName(line)
    return status.drop("source_checksum", "copy_checksum")


def _publish_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a copy that missed some changes of the customers differs from them, and a copy that is up to date."""
    warehouse, copies = _warehouse(spark, sf_dir), _published(spark, sf_dir)
    end = F.substring("customer_id", -2, 2)
    value = F.col("lifetime_value")
    old = copies[LTV].filter(end != "99").withColumn("lifetime_value", F.when(end == "13", value + 1).otherwise(value))
    found = serving.stale_ranges(LTV, warehouse.table(LTV), old, PUBLISHED_KEYS[LTV])
    return found.unionByName(
        serving.stale_ranges(PRODUCTS, warehouse.table(PRODUCTS), copies[PRODUCTS], PUBLISHED_KEYS[PRODUCTS])
    )


def _order_rejects(rows: DataFrame) -> DataFrame:
    return rows.select("order_id", "product_id", "status", "total_amount", F.array_join("reasons", ",").alias("reasons"))


def _click_rejects(rows: DataFrame) -> DataFrame:
    return rows.select("session_id", "customer_id", "event_type", "event_ts", F.array_join("reasons", ",").alias("reasons"))


def _with_beyond(rows: DataFrame) -> DataFrame:
    return rows.drop(*CLOCKS, "_source_file", "_source_ts").withColumnRenamed(BEYOND, "beyond")


def _deleted_sessions(turns: DataFrame) -> DataFrame:
    """Sessions without any reply."""
    replied = F.count_if(F.col("role") == "assistant")
    return turns.groupBy("conv_id").agg(replied.alias("_replies")).filter("_replies = 0").select("conv_id")


def _response_log(turns: DataFrame) -> DataFrame:
    """The turns as logged responses, in the shapes an endpoint answers in.

    User turns come as a message list whose last entry is empty, assistant turns as a message list
    or as choices by whether the turn has a line break, system turns as broken JSON.
    """
    content = F.col("content")

    def message(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), text.alias("content"))

    spoken = F.to_json(F.struct(F.array(message("human", F.lit("?")), message("ai", content)).alias("messages")))
    silent = F.to_json(F.struct(F.array(message("human", content), message("ai", F.lit(""))).alias("messages")))
    choices = F.to_json(
        F.struct(
            F.array(
                F.struct(F.struct(F.lit("").alias("content")).alias("message")),
                F.struct(F.struct(content.alias("content")).alias("message")),
            ).alias("choices")
        )
    )
    log = (
        F.when(F.col("role") == "user", silent)
        .when((F.col("role") == "assistant") & content.contains("\n"), choices)
        .when(F.col("role") == "assistant", spoken)
        .otherwise(F.concat(F.lit("{"), content))
    )
    return turns.select("conv_id", "turn", log.alias("response"))


def _response_answers(source: Tables) -> DataFrame:
    log = _response_log(adapters.conversation_turns(source))
    return log.select("conv_id", "turn", conversations.response_answer(F.col("response")).alias("answer"))


def _appended_turns(source: Tables) -> DataFrame:
    turns = adapters.conversation_turns(source)
    exchanges = conversations.session_index(turns).select(
        "conv_id",
        F.lit(0).cast("bigint").alias("number"),
        F.concat(F.lit("More on: "), "title").alias("question"),
        F.lit("Noted.").alias("answer"),
    )
    return conversations.append_exchanges(turns, exchanges)


def _conversation_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    turns, index = adapters.conversation_turns, conversations.session_index

    def without_deleted(source: Tables) -> DataFrame:
        return conversations.without_messages(turns(source), _deleted_sessions(turns(source)))

    def index_without_deleted(source: Tables) -> DataFrame:
        return conversations.without_sessions(index(turns(source)), _deleted_sessions(turns(source)))

    return {
        "session_messages": _from_tables(lambda s: conversations.session_messages(turns(s))),
        "session_index": _from_tables(lambda s: index(turns(s))),
        "session_list": _from_tables(lambda s: conversations.session_list(index(turns(s)))),
        "packed_prompts": _from_tables(lambda s: conversations.packed_prompts(turns(s))),
        "deleted_sessions": _from_tables(without_deleted),
        "deleted_sessions_index": _from_tables(index_without_deleted),
        "response_answers": _from_tables(_response_answers),
        "appended_turns": _from_tables(_appended_turns),
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query as a function of (spark, folder of the given tables)."""
    clocks_off = _without(*CLOCKS)
    return {
        # silver, from the given tables
        "silver_orders": _from_tables(lambda s: clocks_off(silver.silver_orders(bronze(adapters.orders_feed(s))))),
        "silver_products": _from_tables(lambda s: silver.silver_products(bronze(adapters.products_feed(s)))),
        "silver_clickstream": _from_tables(
            lambda s: clocks_off(silver.silver_clickstream(bronze(adapters.clicks_feed(s))))
        ),
        "silver_customers": _from_tables(lambda s: silver.silver_customers(bronze(adapters.customer_changes(s)))),
        "dq_metrics": _from_tables(_dq(_dq_metrics)),
        "dq_rejects": _from_tables(_dq(_dq_rejects)),
        # gold, from stored silver
        DAILY: _on("silver_orders", query=gold.gold_revenue_daily),
        PRODUCTS: _on("silver_orders", "silver_products", query=gold.gold_top_products),
        SESSIONS: _on("silver_clickstream", query=gold.gold_cart_abandonment),
        LTV: _on("silver_customers", "silver_orders", query=lambda c, o: gold.gold_customer_ltv(c, o, AS_OF)),
        # dashboards and certified answers, from stored gold
        "revenue_trend": _on(DAILY, query=bi.revenue_trend),
        "revenue_by_country": _on(DAILY, query=bi.revenue_by_country),
        "top10_products": _on(PRODUCTS, query=bi.top_products),
        "sessions_per_day": _on(SESSIONS, query=bi.sessions_per_day),
        "ltv_by_segment_country": _on(LTV, query=bi.ltv_by_segment_country),
        "bi_counters": _on(DAILY, query=bi.bi_counters),
        "month_revenue": _on(DAILY, query=lambda d: bi.month_revenue(d, MONTH_DAY)),
        "wow_revenue": _on(DAILY, query=bi.wow_revenue),
        "category_summary": _on(PRODUCTS, query=bi.category_summary),
        "weekly_revenue": _on(DAILY, query=bi.weekly_revenue),
        "moving_avg_7d": _on(DAILY, query=bi.moving_average),
        # parameterised tools
        "revenue_range": _on(
            DAILY, query=lambda d: tools.get_revenue_summary(d, dt.date(2000, 1, 1), dt.date(2000, 3, 31))
        ),
        "top_n_category": _on(PRODUCTS, query=lambda p: tools.get_top_products(p, 25, "ECONOMY")),
        "top_n_all": _on(PRODUCTS, query=lambda p: tools.get_top_products(p, 40, "")),
        "abandonment_rate": _on(SESSIONS, query=lambda s: tools.get_abandonment_rate(s, 14, CLICKS_AS_OF)),
        "at_risk_customers": _on(LTV, query=lambda v: tools.get_at_risk_customers(v, 250_000.0, 120)),
        "sql_revenue_range": _sql_tool(
            "SELECT * FROM get_revenue_summary(DATE'2000-01-01', DATE'2000-03-31')", AS_OF
        ),
        "sql_top_n_category": _sql_tool("SELECT * FROM get_top_products(25, 'ECONOMY')", AS_OF),
        "sql_abandonment_rate": _sql_tool("SELECT * FROM get_abandonment_rate(14)", CLICKS_AS_OF),
        "sql_at_risk_customers": _sql_tool("SELECT * FROM get_at_risk_customers(250000.0D, 120)", AS_OF),
        # questions in words
        "revenue_last_week_best_country": _on(DAILY, query=lambda d: questions.last_week_best_country(d, AS_OF)),
        "return_rate_by_country": _on(DAILY, query=questions.return_rate_by_country),
        "best_margin_category": _on(PRODUCTS, query=questions.best_margin_category),
        "abandoned_pct": _on(SESSIONS, query=questions.abandoned_percent),
        "premium_top_customers": _on(LTV, query=lambda v: questions.top_customers_of_segment(v, "Premium")),
        "high_return_products": _on(PRODUCTS, query=lambda p: questions.high_return_products(p, "PROMO", 20.0)),
        "high_return_margin": _on(PRODUCTS, query=lambda p: questions.high_return_margin(p, "PROMO", 20.0)),
        "best_product_by_country": _on(
            "silver_orders",
            "silver_products",
            query=lambda o, p: questions.best_product_by_country(o, p, *questions.week_before(AS_OF)),
        ),
        "top5_this_month": _on(
            "silver_orders", "silver_products", query=lambda o, p: questions.top_products_of_month(o, p, MONTH_DAY)
        ),
        "premium_idle": _on(LTV, query=questions.premium_idle),
        "weekly_category_revenue": _on("silver_orders", "silver_products", query=questions.weekly_category_revenue),
        "abandonment_trend": _on(
            SESSIONS,
            query=lambda s: questions.abandonment_trend(tools.get_abandonment_rate(s, 30, CLICKS_AS_OF)),
        ),
        "ltv_heatmap": _on(LTV, query=lambda v: questions.ltv_heatmap(v, [f"NATION_{i}" for i in range(25)])),
        "top5_category_flagged": _on(PRODUCTS, query=lambda p: questions.flagged_top_products(p, "STANDARD")),
        "category_revenue_vs_abandonment": _on(
            "silver_orders",
            "silver_products",
            "silver_clickstream",
            SESSIONS,
            query=questions.category_revenue_and_abandonment,
        ),
        # serving, from the published copies
        "publish_reconcile": _publish_reconcile,
        "publish_stale": _publish_stale,
        "kpi_totals": _on_copy(DAILY, query=serving.kpi_totals),
        "kpi_avg_ltv": _on_copy(LTV, query=serving.kpi_avg_ltv),
        "kpi_aov": _on_copy(DAILY, query=serving.kpi_aov),
        "kpi_cards": _on_copy(DAILY, LTV, query=serving.kpi_cards),
        "trend_last_30d": _on_copy(DAILY, query=serving.trend_of_last_days),
        "serving_revenue_by_country": _on_copy(DAILY, query=serving.country_revenue),
        "serving_top_products": _on_copy(PRODUCTS, query=serving.top_product_revenue),
        "serving_top_product_labels": _on_copy(
            PRODUCTS,
            query=lambda p: serving.top_product_revenue(p).withColumn("label", scalars.shortened(F.col("name"), 18)),
        ),
        "segments": _on_copy(LTV, query=serving.segments),
        # governed reads
        "masked_customers": _as_principals(
            "silver_customers",
            "silver_customers",
            ("analyst_NATION_3", "steward_NATION_3"),
            ("customer_id", "first_name", "email", "segment"),
        ),
        "tag_masked_customers": _as_principals(
            "silver_customers",
            "tagged_customers",
            ("analyst_NATION_3", "steward_NATION_3"),
            ("customer_id", "first_name", "last_name", "email", "country"),
        ),
        "filtered_orders": _as_principals(
            "silver_orders",
            "silver_orders",
            ("analyst_NATION_3", "admin_NATION_3"),
            ("order_id", "product_id", "total_amount", "ship_country"),
        ),
        "masked_customers_sample": lambda spark, sf_dir: (
            _reader(spark, sf_dir, "analyst_NATION_3")
            .read("silver_customers", _warehouse(spark, sf_dir).table("silver_customers"))
            .select("customer_id", "first_name", "email", "segment")
            .orderBy("customer_id")
            .limit(10)
        ),
        "sql_masked_customers": _sql_policy(
            "silver_customers",
            "analyst_NATION_3",
            "SELECT customer_id, first_name, mask_email(email) AS email, segment FROM silver_customers",
        ),
        "sql_filtered_orders": _sql_policy(
            "silver_orders",
            "analyst_NATION_3",
            "SELECT order_id, product_id, total_amount, ship_country FROM silver_orders "
            "WHERE filter_by_country(ship_country)",
        ),
        "principal_orders": _principal_orders,
        # conversations
        **_conversation_queries(),
        # landing files, ingested and refreshed by streams
        "ingested_orders": _from_store("bronze_orders", samples.described_orders),
        "ingested_products": _from_store("bronze_products", _with_beyond),
        "ingested_clickstream": _from_store("bronze_clickstream", _with_beyond),
        "ingested_customer_changes": _from_store("bronze_customers_cdc", _without(*CLOCKS)),
        "streamed_silver_orders": _from_store("silver_orders", clocks_off),
        "streamed_silver_clickstream": _from_store("silver_clickstream", clocks_off),
        "streamed_silver_customers": _from_store("silver_customers", clocks_off),
        "streamed_rejects": _from_store("silver_orders_rejects", _order_rejects),
        "streamed_click_rejects": _from_store("silver_clickstream_rejects", _click_rejects),
        "streamed_dq_metrics": _from_store("silver_checks", lambda lines: lines),
        "interval_silver_orders": _interval_orders,
        "full_refresh_difference": _full_refresh_difference,
        "refreshed_silver_products": _from_store("silver_products", clocks_off),
        "refreshed_revenue_daily": _from_store(DAILY, clocks_off),
        "refreshed_top_products": _from_store(PRODUCTS, clocks_off),
        "refreshed_cart_abandonment": _from_store(SESSIONS, clocks_off),
        "refreshed_customer_ltv": _from_store(LTV, clocks_off),
        # seeded sample feeds, one row per row of a given table
        "generated_customers": _from_tables(samples.generated_customers),
        "generated_products": _from_tables(samples.generated_products),
        "generated_orders": _from_tables(samples.generated_orders),
        "generated_clicks": _from_tables(samples.generated_clicks),
        # operators for training text
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    """The same queries in SQL over the given tables."""
    own = oracle_queries.all_queries(
        as_of=AS_OF, month_day=MONTH_DAY, clicks_as_of=CLICKS_AS_OF, week=questions.week_before(AS_OF)
    )
    return {**own, **LLM_ORACLES}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: revenue by country, from order lines through silver and daily gold."""
    return queries()["revenue_by_country"](spark, "/root/testdata/sf0.001")
