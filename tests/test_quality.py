import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shelfline.operators.quality import CLICK_CHECKS, ORDER_CHECKS, Expectation, enforce, metrics, observed, rejects

ROWS = [
    ("O1", "C1", 5.0, "completed"),
    (None, "C1", 5.0, "completed"),
    ("O3", None, 5.0, "returned"),
    ("O4", "C1", 0.0, "pending"),
    ("O5", "C1", -1.0, "cancelled"),
    ("O6", "C1", None, "completed"),
    ("O7", "C1", 5.0, "unknown"),
    ("O8", "C1", 5.0, None),
    (None, None, None, None),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "order_id string, customer_id string, total_amount double, status string")


def test_dropping_checks_drop_and_warnings_keep(rows):
    assert [r.order_id for r in enforce(rows, ORDER_CHECKS).collect()] == ["O1", "O7", "O8"]


def test_null_counts_as_failed_and_counts_add_up(rows):
    got = {r.constraint_name: r for r in metrics(rows, "silver_orders", ORDER_CHECKS).collect()}
    assert {n: (r.passed, r.failed) for n, r in got.items()} == {
        "valid_order_id": (7, 2),
        "valid_customer": (7, 2),
        "positive_amount": (5, 4),
        "valid_status": (6, 3),
    }
    assert [r.action for r in got.values()] == ["drop", "drop", "drop", "warn"]


def test_kept_and_rejected_are_the_whole(rows):
    rejected = rejects(rows, ORDER_CHECKS)
    assert enforce(rows, ORDER_CHECKS).count() + rejected.count() == len(ROWS)
    reasons = {r.order_id: r.reasons for r in rejected.filter("customer_id IS NOT NULL").collect()}
    assert reasons["O4"] == ["positive_amount"] and reasons[None] == ["valid_order_id"]
    worst = rejected.filter("order_id IS NULL AND customer_id IS NULL").head()
    assert worst.reasons == ["valid_order_id", "valid_customer", "positive_amount"]


def test_batch_observation_counts_before_the_drop(rows):
    observation = Observation("orders")
    checked = rows.observe(observation, *[check_count(c) for c in ORDER_CHECKS])
    assert enforce(checked, ORDER_CHECKS).count() == 3
    assert observation.get["positive_amount"] == 5


def check_count(check):
    return F.count_if(check.holds()).alias(check.name)


def test_no_checks_change_nothing(rows):
    assert enforce(rows, [Expectation("any", "1 = 0", drop=False)]).count() == len(ROWS)


def test_click_checks(spark):
    clicks = spark.createDataFrame(
        [("E1", "search"), (None, "search"), ("E3", "error")], "event_id string, event_type string"
    )
    assert [r.event_id for r in enforce(clicks, CLICK_CHECKS).collect()] == ["E1", "E3"]
    assert observed(clicks, "x", CLICK_CHECKS).columns == clicks.columns
