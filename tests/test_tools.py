"""The SQL table functions give what the Python functions give."""

import datetime as dt

import pytest

import __spark_entry__ as entry
from shelfline.functions import tools

TODAY = dt.date(2024, 1, 31)


@pytest.fixture(scope="module")
def gold(spark, sf_dir):
    tables = entry._warehouse(spark, sf_dir).gold()
    tools.register(spark, tables, as_of=TODAY)
    return tables


def test_revenue_summary(spark, gold):
    start, end = dt.date(2000, 1, 1), dt.date(2000, 1, 31)
    want = tools.get_revenue_summary(gold["gold_revenue_daily"], start, end)
    got = spark.sql("SELECT * FROM get_revenue_summary(DATE'2000-01-01', DATE'2000-01-31')")
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(got.collect()) == sorted(want.collect())
    # Ordered by day, then by revenue from the top.
    order = [(r.order_day, -r.total_revenue) for r in want.collect()]
    assert order == sorted(order)


@pytest.mark.parametrize("category", ["", "ECONOMY", "no such"])
def test_top_products(spark, gold, category):
    want = tools.get_top_products(gold["gold_top_products"], 7, category).collect()
    got = spark.sql(f"SELECT * FROM get_top_products(7, '{category}')").collect()
    assert sorted(got) == sorted(want) and len(got) == (0 if category == "no such" else 7)


def test_many_top_products(spark, gold):
    want = tools.get_top_products(gold["gold_top_products"], 1500, "").collect()
    got = spark.sql("SELECT * FROM get_top_products(1500, '')").collect()
    assert sorted(got) == sorted(want) and len(got) == 1500


def test_top_products_without_category(spark, gold):
    assert spark.sql("SELECT * FROM get_top_products(5, NULL)").count() == 5


def test_abandonment_rate(spark, gold):
    want = tools.get_abandonment_rate(gold["gold_cart_abandonment"], 10, TODAY).collect()
    got = spark.sql("SELECT * FROM get_abandonment_rate(10)").collect()
    assert got == want and len(got) == 10


def test_at_risk(spark, gold):
    want = tools.get_at_risk_customers(gold["gold_customer_ltv"], 500000.0, 30).collect()
    assert spark.sql("SELECT * FROM get_at_risk_customers(500000.0D, 30)").collect() == want
    assert all(a.lifetime_value >= b.lifetime_value for a, b in zip(want, want[1:]))


def test_functions_compose_in_sql(spark, gold):
    row = spark.sql(
        "SELECT ship_country, sum(total_revenue) r FROM get_revenue_summary(DATE'2000-01-01', DATE'2000-12-31') "
        "GROUP BY ship_country ORDER BY r DESC LIMIT 1"
    ).head()
    assert row.r > 0
