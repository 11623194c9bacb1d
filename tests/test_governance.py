import pytest
from conftest import plan_of

from shelfline.functions import governance as gov
from shelfline.functions.scalars import mask_email


@pytest.fixture
def memberships(spark):
    rows = [("root", "data_admin"), ("root", "pii_access"), ("steward", "pii_access"), ("ann", "analysts")]
    return spark.createDataFrame(rows, "principal string, `group` string")


@pytest.fixture
def customers(spark):
    rows = [("C1", "Alice", "Smith", "alice@mail.example.com", "x"), ("C2", "Bob", "Jones", None, "y")]
    return gov.tag_columns(
        spark.createDataFrame(rows, "customer_id string, first_name string, last_name string, email string, note string"),
        gov.CUSTOMER_TAGS,
    )


@pytest.fixture
def orders(spark):
    return spark.createDataFrame([("O1", "Germany"), ("O2", "US"), ("O3", None)], "order_id string, ship_country string")


POLICIES = {
    "customers": gov.Policy(masks={"email": mask_email}),
    "tagged": gov.Policy(mask_by_tags=True),
    "orders": gov.Policy(row_filter=gov.country_filter),
}


def test_mask_by_group(customers, memberships):
    def emails(who):
        return [r.email for r in gov.GovernedReader(who, memberships, POLICIES).read("customers", customers).collect()]

    assert emails("steward") == ["alice@mail.example.com", None]
    assert emails("ann") == emails("nobody") == ["ali***@***.***", None]


def test_tags_drive_masks_and_survive_storage(spark, customers, memberships, scratch):
    customers.filter("note = 'x'").write.parquet(scratch)
    stored = spark.read.parquet(scratch)
    assert gov.tagged_columns(stored) == {"email": "email", "first_name": "name", "last_name": "name"}
    seen = gov.GovernedReader("ann", memberships, POLICIES).read("tagged", stored).head()
    assert tuple(seen) == ("C1", "A***", "S***", "ali***@***.***", "x")


def test_tag_of_an_unknown_kind_hides_the_column(customers):
    tagged = gov.tag_columns(customers, {"note": {"pii": "true", "pii_type": "health"}})
    assert gov.mask_tagged(tagged).head().note is None


def test_row_filter_by_group(orders, memberships):
    def ids(who):
        return [r.order_id for r in gov.GovernedReader(who, memberships, POLICIES).read("orders", orders).collect()]

    assert ids("root") == ["O1", "O2", "O3"]
    assert ids("steward") == ids("ann") == ["O1"]


def test_row_filter_reaches_the_scan(spark, orders, memberships, scratch):
    orders.write.parquet(scratch)
    reader = gov.GovernedReader("ann", memberships, POLICIES)
    plan = plan_of(reader.read("orders", spark.read.parquet(scratch)).filter("order_id > 'O0'"))
    assert "EqualTo(ship_country,Germany)" in plan


def test_rows_of_principal(spark, orders):
    lookup = spark.createDataFrame(
        [("ann", "US"), ("ann", "US"), ("ben", "Germany")], "principal string, country string"
    )
    assert [r.order_id for r in gov.rows_of_principal(orders, "ship_country", "ann", lookup).collect()] == ["O2"]
    assert gov.rows_of_principal(orders, "ship_country", "eve", lookup).count() == 0


def test_sql_functions(spark, memberships, customers, orders):
    customers.createOrReplaceTempView("gov_customers")
    orders.createOrReplaceTempView("gov_orders")
    query = "SELECT mask_email(email) e FROM gov_customers WHERE customer_id = 'C1'"
    for who, email, rows in (("ann", "ali***@***.***", 1), ("root", "alice@mail.example.com", 3)):
        gov.GovernedReader(who, memberships, POLICIES).register(spark)
        assert spark.sql(query).head().e == email
        assert spark.sql("SELECT * FROM gov_orders WHERE filter_by_country(ship_country)").count() == rows


def test_masked_sample_for_both_principals(customers, memberships):
    for who, shown in (("ann", "ali***@***.***"), ("steward", "alice@mail.example.com")):
        seen = gov.GovernedReader(who, memberships, POLICIES).read("customers", customers)
        sample = seen.select("customer_id", "first_name", "email").orderBy("customer_id").limit(10)
        assert sample.head().email == shown
