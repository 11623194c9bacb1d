"""Behaviour that is easy to get wrong, each on a few literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline.functions import scalars, tools
from shelfline.operators import money
from shelfline.operators.newest import newest_per_key
from shelfline.plans import bi, gold, questions, serving, silver

DAY = dt.date(2024, 3, 15)
ORDER = "order_id string, customer_id string, product_id string, quantity int, total_amount double, status string, order_date timestamp, ship_country string"


def at(day, hour=0):
    return dt.datetime(2024, 3, day, hour)


@pytest.fixture
def orders(spark):
    rows = [
        ("O1", "C1", "P1", 1, 10.10, "completed", at(1, 9), "DE"),
        ("O1", "C1", "P2", 2, 20.20, "returned", at(1, 9), "DE"),
        ("O2", "C1", "P1", 1, 30.30, "cancelled", at(1, 23), "DE"),
        ("O3", "C2", "P1", 3, 40.40, "pending", at(2), "DE"),
        ("O4", "C3", "P3", 1, 50.50, None, at(2), "FR"),
        ("O5", "C3", "P3", 1, 60.60, "lost", at(2), "FR"),
        ("O6", "C4", None, 1, 70.70, "cancelled", at(3), None),
    ]
    return spark.createDataFrame(rows, ORDER)


def daily_rows(spark, rows):
    return spark.createDataFrame(
        rows, "order_day date, ship_country string, order_count bigint, total_revenue double, avg_order_value double"
    )


def test_daily_revenue_keeps_all_known_statuses_and_drops_others(orders):
    got = {(str(r.order_day), r.ship_country): r for r in gold.gold_revenue_daily(orders).collect()}
    assert set(got) == {("2024-03-01", "DE"), ("2024-03-02", "DE"), ("2024-03-03", None)}
    first = got["2024-03-01", "DE"]
    assert (first.order_count, first.total_revenue, first.avg_order_value) == (2, 60.6, 20.2)
    assert (first.returns, first.cancellations) == (1, 1)


def test_order_count_is_distinct_within_its_group_only(spark):
    rows = [("O1", "C", "P", 1, 1.0, "completed", at(1), c) for c in ("DE", "DE", "FR")]
    daily = gold.gold_revenue_daily(spark.createDataFrame(rows, ORDER))
    assert bi.revenue_by_country(daily).agg(F.sum("total_orders")).head()[0] == 2


def test_product_revenue_has_no_status_filter(spark, orders):
    products = spark.createDataFrame(
        [("P1", "a", "x", "b", 5.0, 1.0), ("P3", "c", "x", "b", 5.0, 1.0), ("P9", "never sold", "x", "b", 5.0, 1.0)],
        "product_id string, product_name string, category string, brand string, price double, margin_pct double",
    )
    got = {r.product_id: r for r in gold.gold_top_products(orders, products).collect()}
    assert set(got) == {"P1", "P3"}
    assert (got["P1"].total_revenue, got["P1"].units_sold, got["P1"].orders_count) == (80.8, 5, 3)
    assert got["P3"].total_revenue == 111.1
    assert got["P1"].return_rate_pct == 0.0


def test_lifetime_value_keeps_customers_without_orders(spark, orders):
    customers = spark.createDataFrame(
        [(c, "Premium", "DE", True) for c in ("C1", "C2", "C3", "C4", "C5")],
        "customer_id string, segment string, country string, is_active boolean",
    )
    ltv = gold.gold_customer_ltv(customers, orders, DAY)
    got = {r.customer_id: r for r in ltv.collect()}
    # C2 and C4 have orders, but none that counts; C5 has no order at all.
    assert set(got) == {"C1", "C3", "C5"}
    assert (got["C1"].total_orders, got["C1"].lifetime_value, got["C1"].days_since_last_order) == (1, 10.1, 14)
    assert (got["C3"].total_orders, got["C3"].lifetime_value) == (1, 50.5)  # an order without status counts
    assert (got["C5"].total_orders, got["C5"].lifetime_value, got["C5"].days_since_last_order) == (0, None, None)
    # Missing value or recency never passes the thresholds.
    assert {r.customer_id for r in tools.get_at_risk_customers(ltv, 0.0, 0).collect()} == {"C1", "C3"}
    assert serving.kpi_avg_ltv(ltv).head().avg_ltv == 30.3
    assert serving.segments(ltv).head()["count"] == 3


def test_sum_of_daily_revenue_is_the_sum_of_accepted_orders(orders):
    daily = gold.gold_revenue_daily(orders)
    assert serving.kpi_totals(daily).head().revenue == pytest.approx(10.1 + 20.2 + 30.3 + 40.4 + 70.7)


def test_sessions(spark):
    def event(session, customer, kind, minute):
        return (session, customer, kind, dt.datetime(2024, 3, 1, 10, minute, 20))

    clicks = spark.createDataFrame(
        [
            event("S1", "C1", "add_to_cart", 0),
            event("S1", "C1", "view_product", 7),
            event("S1", "C2", "add_to_cart", 1),
            event("S1", "C2", "purchase", 2),
            event("S2", "C1", "purchase", 3),
            event("S3", "C1", "search", 4),
            ("S3", "C1", None, dt.datetime(2024, 3, 1, 10, 4, 23)),
        ],
        "session_id string, customer_id string, event_type string, event_ts timestamp",
    )
    sessions = gold.gold_cart_abandonment(clicks)
    got = {(r.session_id, r.customer_id): r for r in sessions.collect()}
    assert len(got) == 4
    assert [k for k, r in got.items() if r.abandoned] == [("S1", "C1")]
    assert got["S1", "C1"].duration_mins == 7.0
    assert got["S3", "C1"].duration_mins == 0.1  # 3 seconds are 0.05 minutes, rounded up
    assert got["S2", "C1"].duration_mins == 0.0
    # The rate divides by all sessions, not by those with a cart.
    assert questions.abandoned_percent(sessions).head().abandonment_rate_pct == 25.0
    rates = tools.get_abandonment_rate(sessions, 14, DAY).collect()
    assert [(str(r.day), r.total_sessions, r.abandoned_sessions) for r in rates] == [("2024-03-01", 4, 1)]
    assert tools.get_abandonment_rate(sessions, 13, DAY).count() == 0


def test_newest_delivery_of_a_product_wins_and_ties_are_repeatable(spark):
    rows = [
        ("P1", "old", 10.0, 4.0, 1),
        ("P1", "new", 0.0, 4.0, 2),
        ("P2", "a", 10.0, 12.5, 1),
        ("P2", "b", 10.0, 12.5, 1),
    ]
    bronze = spark.createDataFrame(rows, "product_id string, name string, price double, cost double, at int").select(
        "*",
        F.lit("x").alias("category"),
        F.lit("y").alias("brand"),
        F.lit(3).alias("stock_qty"),
        F.lit(4.5).alias("rating"),
        F.timestamp_seconds("at").alias("_ingestion_ts"),
    )
    got = {r.product_id: r for r in silver.silver_products(bronze.drop("at")).collect()}
    assert got["P1"].product_name == "new" and got["P1"].margin_pct is None  # price 0
    assert got["P2"].margin_pct == -25.0
    names = {
        silver.silver_products(bronze.drop("at").repartition(n, "name")).filter("product_id = 'P2'").head().product_name
        for n in (1, 3, 5)
    }
    assert len(names) == 1


def test_newest_per_key_ignores_rows_without_order(spark):
    rows = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("b", None, 3)], "k string, o int, v int")
    assert {(r.k, r.v) for r in newest_per_key(rows, ["k"], [F.col("o")]).collect()} == {("a", 2), ("b", 3)}


def test_empty_category_means_every_named_category(spark):
    products = spark.createDataFrame(
        [(f"P{i}", f"n{i}", c, "b", 1, float(i), 1.0, 2.0) for i, c in enumerate(["x", "x", "y", None])],
        "product_id string, product_name string, category string, brand string, units_sold bigint, "
        "total_revenue double, margin_pct double, return_rate_pct double",
    )
    for everything in ("", None):
        assert [r.product_name for r in tools.get_top_products(products, 9, everything).collect()] == ["n2", "n1", "n0"]
    assert [r.product_name for r in tools.get_top_products(products, 1, "x").collect()] == ["n1"]


def test_top_products_break_ties_by_key(spark):
    products = spark.createDataFrame(
        [(f"P{i}", f"n{i}", "x", "b", 1, 5.0, 1.0, 2.0) for i in (3, 1, 2)],
        "product_id string, product_name string, category string, brand string, units_sold bigint, "
        "total_revenue double, margin_pct double, return_rate_pct double",
    )
    assert [r.product_name for r in bi.top_products(products, 2).collect()] == ["n1", "n2"]


def test_week_over_week_uses_the_row_before_and_guards_zero(spark):
    monday = dt.date(2024, 1, 1)
    weeks = [(0, 100.0), (1, 0.0), (4, 50.0), (5, 75.0)]
    daily = daily_rows(spark, [(monday + dt.timedelta(weeks=w, days=3), "DE", 1, v, v) for w, v in weeks])
    got = bi.wow_revenue(daily).collect()
    assert [r.week_start.date() for r in got] == [monday + dt.timedelta(weeks=w) for w, _ in reversed(weeks)]
    assert [r.prev_week_revenue for r in got] == [50.0, 0.0, 100.0, None]
    assert [r.wow_change_pct for r in got] == [50.0, None, -100.0, None]
    assert len(bi.wow_revenue(daily, weeks=2).collect()) == 2


def test_mean_of_means_differs_from_totals_ratio(spark):
    daily = daily_rows(spark, [(DAY, "DE", 1, 10.0, 10.0), (DAY, "FR", 3, 90.0, 30.0)])
    assert bi.bi_counters(daily).head().avg_order_value == 20.0
    assert serving.kpi_aov(daily).head().aov == 25.0


def test_empty_totals_are_zero(spark):
    empty = daily_rows(spark, [])
    assert tuple(serving.kpi_totals(empty).head()) == (0.0, 0)
    assert serving.kpi_aov(empty).head().aov == 0.0


def test_trailing_days_count_from_the_last_day_of_the_table(spark):
    days = [dt.date(2020, 1, 31), dt.date(2020, 1, 1), dt.date(2019, 12, 31)]
    daily = daily_rows(spark, [(d, "DE", 1, 1.0, 1.0) for d in days])
    assert [r.day for r in serving.trend_of_last_days(daily).collect()] == [dt.date(2020, 1, 1), dt.date(2020, 1, 31)]


def test_month_is_the_calendar_month(spark):
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    daily = daily_rows(spark, [(d, "DE", 1, 1.0, 1.0) for d in days])
    assert bi.month_revenue(daily, dt.date(2024, 1, 20)).head().current_month_orders == 2
    assert bi.month_revenue(daily, dt.date(2023, 12, 1)).head().current_month_orders == 1


def test_sums_do_not_depend_on_row_order(spark):
    rows = spark.range(20_000).select((F.col("id") * 7919 % 100_003 / 100).alias("x"), (F.col("id") % 3).alias("g"))
    results = {
        tuple(sorted(map(tuple, rows.repartition(n).groupBy("g").agg(money.total("x"), money.mean("x")).collect())))
        for n in (1, 2, 7, 16)
    }
    assert len(results) == 1


@pytest.mark.parametrize(
    "email, masked",
    [
        ("alice@mail.example.com", "ali***@***.***"),
        ("a@b.com", "a***@***.***"),
        ("bo@x.co.uk", "bo***@***.***"),
        ("no address", "no address"),
        ("@b.com", "@b.com"),
        ("", ""),
        (None, None),
    ],
)
def test_email_mask(spark, email, masked):
    row = spark.createDataFrame([(email,)], "e string").select(scalars.mask_email(F.col("e")))
    assert row.head()[0] == masked


def test_keys_longer_than_their_width_are_kept(spark):
    ids = spark.createDataFrame([(7,), (1234567,), (123456789,)], "id bigint")
    assert [r[0] for r in ids.select(scalars.padded_key("O", F.col("id"), 7)).collect()] == [
        "O0000007",
        "O1234567",
        "O123456789",
    ]


def test_text_is_cut_only_when_longer(spark):
    rows = spark.createDataFrame([("x" * 18,), ("x" * 19,)], "t string")
    assert [r[0] for r in rows.select(scalars.shortened(F.col("t"), 18)).collect()] == ["x" * 18, "x" * 18 + "..."]


def test_kpi_cards(spark):
    daily = daily_rows(spark, [(DAY, "DE", 1200, 1234567.89, 10.0)])
    ltv = spark.createDataFrame([(10.0,), (0.0,), (None,)], "lifetime_value double")
    cards = {r.label: r.value for r in serving.kpi_cards(daily, ltv).collect()}
    assert cards == {
        "Total Revenue": "$1,234,568",
        "Total Orders": "1,200",
        "Avg Order Value": "$1,028.81",
        "Avg Customer LTV": "$10.00",
    }


def test_unreadable_values_become_null_and_are_then_dropped(spark):
    rows = spark.createDataFrame(
        [("O1", "x", "12.5", "2024-01-01 10:00:00"), ("O2", "2", "abc", "bad date")],
        "order_id string, quantity string, total_amount string, order_date string",
    ).select(
        "*",
        F.lit("C").alias("customer_id"),
        F.lit("P").alias("product_id"),
        F.lit("1").alias("unit_price"),
        F.lit("completed").alias("status"),
        F.lit("DE").alias("ship_country"),
        F.current_timestamp().alias("_ingestion_ts"),
    )
    got = silver.silver_orders(rows).collect()
    assert [(r.order_id, r.quantity, r.total_amount) for r in got] == [("O1", None, 12.5)]


def test_last_week_is_the_calendar_week_before():
    assert questions.week_before(dt.date(2024, 3, 15)) == (dt.date(2024, 3, 4), dt.date(2024, 3, 10))
    assert questions.week_before(dt.date(2024, 3, 11)) == (dt.date(2024, 3, 4), dt.date(2024, 3, 10))


def test_prices_that_came_as_text_have_a_margin(spark):
    bronze = spark.createDataFrame(
        [("P1", "n", "c", "b", "10", "7.5", "3", "4.5", 1), ("P2", "n", "c", "b", "free", "1", "x", "", 1)],
        "product_id string, name string, category string, brand string, price string, cost string, "
        "stock_qty string, rating string, at int",
    ).withColumn("_ingestion_ts", F.timestamp_seconds("at"))
    got = {r.product_id: r for r in silver.silver_products(bronze.drop("at")).collect()}
    assert (got["P1"].margin_pct, got["P1"].stock_qty, got["P1"].rating) == (25.0, 3, 4.5)
    assert (got["P2"].price, got["P2"].margin_pct, got["P2"].stock_qty) == (None, None, None)
