import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline.sources import generate as gen

END = dt.datetime(2025, 1, 1, 12)


def feeds(ids, n=1000, seed=42):
    return {
        "customers": gen.customers(ids, seed),
        "products": gen.products(ids, seed),
        "orders": gen.orders(ids, n, END, seed=seed),
        "clicks": gen.clicks(ids, n, END, seed=seed),
    }


def checksum(df):
    return df.agg(F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)"))).head()[0]


@pytest.mark.parametrize("name", ["customers", "products", "orders", "clicks"])
def test_same_for_any_partitioning_and_other_for_another_seed(spark, name):
    ids = gen.ids(spark, 1000)
    sums = {checksum(feeds(ids.repartition(n))[name]) for n in (1, 3, 8)}
    assert len(sums) == 1
    assert checksum(feeds(ids, seed=7)[name]) not in sums


def shares(df, column):
    n = df.count()
    return {r[0]: r["count"] / n for r in df.groupBy(column).count().collect()}


def test_distributions(spark):
    rows = feeds(gen.ids(spark, 20_000), 20_000)
    segments = shares(rows["customers"], "segment")
    assert segments["Premium"] == pytest.approx(0.2, abs=0.02)
    assert segments["Standard"] == pytest.approx(0.5, abs=0.02)
    assert shares(rows["customers"], "country")["US"] == pytest.approx(0.4, abs=0.02)
    assert shares(rows["customers"], "is_active")[True] == pytest.approx(0.75, abs=0.02)
    assert shares(rows["orders"], "status")["completed"] == pytest.approx(0.5, abs=0.02)
    assert shares(rows["clicks"], "product_id")[None] == pytest.approx(20 / 220, abs=0.01)
    assert len(shares(rows["clicks"], "event_type")) == 7


def test_values_stay_in_their_ranges(spark):
    rows = feeds(gen.ids(spark, 5000), 5000)
    for name, (low, high) in gen.PRICE_RANGES.items():
        found = rows["products"].filter(F.col("category") == name).agg(
            F.min("price"), F.max("price"), F.min("cost"), F.max("cost"), F.max("stock_qty"), F.min("rating"), F.max("rating")
        )
        price_low, price_high, cost_low, cost_high, stock, worst, best = found.head()
        assert low <= price_low <= price_high <= high
        assert 0.4 * low - 0.001 <= cost_low <= cost_high <= 0.6 * high + 0.001
        assert stock <= 500 and 3.0 <= worst <= best <= 5.0
    wrong = rows["orders"].filter(F.round(F.col("quantity") * F.col("unit_price"), 2) != F.col("total_amount"))
    assert wrong.count() == 0
    span = rows["orders"].agg(F.min("order_date"), F.max("order_date"), F.min("unit_price"), F.max("unit_price")).head()
    assert span[0] == "2024-01-02 12:00:00" and span[1] == "2025-01-01 12:00:00"
    assert 5.0 <= span[2] <= span[3] <= 1500.0


def test_keys(spark):
    rows = feeds(gen.ids(spark, 300), 300)
    assert rows["customers"].orderBy("customer_id").head().customer_id == "C00001"
    assert rows["products"].agg(F.max("product_id")).head()[0] == "P0300"
    assert rows["customers"].filter("customer_id = 'C00025'").head().signup_date == "2022-01-02"
    assert rows["orders"].agg(F.max("customer_id") <= "C05000").head()[0]


def test_one_row_feed(spark):
    assert gen.orders(gen.ids(spark, 1), 1, END).head().order_date == "2024-01-02 12:00:00"
