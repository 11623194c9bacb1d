"""What the plans must look like to hold at scale."""

import datetime as dt
import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shelfline.functions import tools
from shelfline.plans import bi, conversations, gold, questions, serving, silver
from shelfline.sources import adapters
from shelfline.sources.adapters import Tables


@pytest.fixture(scope="module")
def warehouse(spark, sf_dir):
    return entry._warehouse(spark, sf_dir)


def read_columns(plan):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*)>", plan)]


def own_queries():
    return {name: query for name, query in entry.queries().items() if name not in entry.LLM_QUERIES}


def test_no_query_multiplies_two_tables(spark, sf_dir):
    for name, query in own_queries().items():
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_no_query_leaves_the_jvm(spark, sf_dir):
    for name, query in own_queries().items():
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Python|Pandas|MapIn|ArrowEval", plan), name


def test_date_range_reaches_the_scan(warehouse):
    daily = warehouse.table("gold_revenue_daily")
    plan = plan_of(tools.get_revenue_summary(daily, dt.date(2000, 1, 1), dt.date(2000, 1, 31)))
    assert "GreaterThanOrEqual(order_day,2000-01-01)" in plan and "LessThanOrEqual(order_day,2000-01-31)" in plan
    assert read_columns(plan) == [set(tools.REVENUE_COLUMNS)]
    plan = plan_of(bi.month_revenue(daily, dt.date(2000, 2, 10)))
    assert "GreaterThanOrEqual(order_day,2000-02-01)" in plan and "LessThan(order_day,2000-03-01)" in plan


def test_months_outside_the_span_are_not_read(warehouse):
    orders = warehouse.table("silver_orders")
    week = questions.orders_between(orders, dt.date(2001, 7, 23), dt.date(2001, 7, 30))
    plan = plan_of(week.groupBy("product_id").agg(F.sum("quantity")))
    assert re.search(r"PartitionFilters: \[[^\]]*order_month[^\]]*2001-07-01", plan)
    assert len(week.inputFiles()) == len(orders.inputFiles())  # the files of the relation, before pruning
    scan = week.select("quantity")
    scan.collect()
    assert "order_month=1995" not in plan
    assert read_columns(plan) == [{"product_id", "quantity", "order_date"}]


def test_columns_are_pruned(warehouse):
    plan = plan_of(serving.top_product_revenue(warehouse.table("gold_top_products")))
    assert read_columns(plan) == [{"product_id", "product_name", "total_revenue"}]
    plan = plan_of(bi.sessions_per_day(warehouse.table("gold_cart_abandonment")))
    assert read_columns(plan) == [{"session_start"}]


def test_top_k_does_not_sort_everything(warehouse):
    products, ltv = warehouse.table("gold_top_products"), warehouse.table("gold_customer_ltv")
    for df in (
        bi.top_products(products),
        tools.get_top_products(products, 5000, ""),
        tools.get_at_risk_customers(ltv, 1.0, 1),
        serving.top_product_revenue(products),
    ):
        plan = plan_of(df)
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_rank_per_group_is_cut_before_the_shuffle(warehouse):
    best = questions.best_product_by_country(
        warehouse.table("silver_orders"), warehouse.table("silver_products"), dt.date(2000, 1, 1), dt.date(2000, 6, 30)
    )
    plan = plan_of(best)
    assert "row_number(), 1, Partial" in plan


def test_newest_row_is_reduced_on_the_map_side(spark, sf_dir):
    plan = plan_of(silver.silver_products(adapters.bronze(adapters.products_feed(Tables(spark, sf_dir)))))
    shuffled = plan[plan.index("Exchange") :]
    assert "row_number(), 1, Final" in plan and "row_number(), 1, Partial" in shuffled


def test_orders_are_reduced_before_they_meet_products_and_customers(warehouse, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    for name in ("gold_top_products", "gold_customer_ltv"):
        plan = plan_of(warehouse.define(name))
        join = plan.index("SortMergeJoin")
        assert plan.index("count(distinct") > join, name  # the aggregate lies below the join
        assert "HashAggregate" not in plan[:join], name


def test_distinct_counts_spread_a_hot_group(warehouse):
    plan = plan_of(warehouse.define("gold_revenue_daily"))
    assert re.search(r"hashpartitioning\(_groupingexpression#\d+, ship_country#\d+, order_id#\d+", plan)
    assert "Expand" not in plan


def test_outer_join_stays_outer(warehouse, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    assert "LeftOuter" in plan_of(warehouse.define("gold_customer_ltv"))


def test_hot_key_of_a_join_is_split(spark, settings, scratch):
    """A third of the lines on one order: adaptive execution splits its partition."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20kb",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20kb",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    n = 60_000
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    spark.range(n, numPartitions=8).select(
        hot.alias("l_orderkey"),
        (F.col("id") % 100).alias("l_partkey"),
        F.lit(2.0).alias("l_quantity"),
        F.rand(1).alias("l_extendedprice") + 1,
        F.lit(0.0).alias("l_discount"),
        F.lit("N").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"),
    ).toDF(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus"
    ).write.parquet(f"{scratch}/lineitem.parquet")
    spark.range(5000).selectExpr(
        "id AS o_orderkey", "id % 50 AS o_custkey", "timestamp_ntz'2020-01-01 00:00:00' AS o_orderdate"
    ).write.parquet(f"{scratch}/orders.parquet")
    spark.range(50).selectExpr("id AS c_custkey", "CAST(id % 3 AS INT) AS c_nationkey").write.parquet(
        f"{scratch}/customer.parquet"
    )
    spark.range(3).selectExpr("CAST(id AS INT) AS n_nationkey", "concat('N', id) AS n_name").write.parquet(
        f"{scratch}/nation.parquet"
    )
    feed = silver.silver_orders(adapters.bronze(adapters.orders_feed(Tables(spark, scratch))))
    daily = gold.gold_revenue_daily(feed)
    assert daily.count() == 3
    rows = feed.groupBy("ship_country").agg(F.count("*").alias("n"), F.sum("total_amount"), F.max("product_id"))
    assert sum(r.n for r in rows.collect()) == n
    assert "isSkew=true" in plan_of(rows) or "skew=true" in plan_of(rows)


def test_windows_without_partition_run_on_reduced_rows(warehouse):
    for df in (
        bi.wow_revenue(warehouse.table("gold_revenue_daily")),
        bi.moving_average(warehouse.table("gold_revenue_daily")),
    ):
        plan = plan_of(df)
        assert plan.index("Window") < plan.index("HashAggregate")


def test_prompt_texts_are_shuffled_once(spark, sf_dir, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(conversations.packed_prompts(adapters.conversation_turns(Tables(spark, sf_dir))))
    assert len(re.findall(r"partial_collect_list", plan)) == 1
    assert [c for c in read_columns(plan) if "text" in c] == [{"conv_id", "turn", "role", "text"}]
    # Above the gathered texts the join finds them placed by (conv_id, part) already.
    top = plan[: plan.index("collect_list")]
    assert "Exchange" not in top[top.index("SortMergeJoin") :]


def test_session_sort_is_by_ranges_of_session_and_turn(spark, sf_dir):
    plan = plan_of(conversations.session_messages(adapters.conversation_turns(Tables(spark, sf_dir))))
    assert re.search(r"rangepartitioning\(conv_id#\d+L ASC NULLS FIRST, turn#\d+L", plan)


def test_messages_of_a_hot_session_are_spread_before_they_are_deleted(spark, settings, scratch):
    """Two thirds of the messages in one session: adaptive execution splits its side of the anti join."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20kb",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20kb",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    hot = F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 500)
    turns = spark.range(60_000, numPartitions=8).select(
        hot.alias("conv_id"), F.col("id").alias("turn"), F.sha2(F.col("id").cast("string"), 256).alias("content")
    )
    turns.write.parquet(f"{scratch}/turns")
    kept = conversations.without_messages(spark.read.parquet(f"{scratch}/turns"), spark.range(100, 200).toDF("conv_id"))
    assert kept.count() == 60_000 - turns.filter("conv_id BETWEEN 100 AND 199").count()
    longest = kept.select(F.max(F.length("content")))
    longest.collect()
    plan = plan_of(longest)
    assert "LeftAnti" in plan and re.search(r"isSkew=true|skew=true", plan)


@pytest.mark.parametrize("run", ["tool", "sql", "trend"])
def test_months_of_sessions_outside_the_span_are_not_read(spark, sf_dir, warehouse, run):
    sessions = warehouse.table("gold_cart_abandonment")
    if run == "sql":
        tools.register(spark, warehouse.gold(), entry.CLICKS_AS_OF)
        rates = spark.sql("SELECT * FROM get_abandonment_rate(14)")
    else:
        rates = tools.get_abandonment_rate(sessions, 14, entry.CLICKS_AS_OF)
    plan = plan_of(questions.abandonment_trend(rates) if run == "trend" else rates)
    assert re.search(r"PartitionFilters: \[[^\]]*session_month#\d+ >= 2024-01-01", plan)
