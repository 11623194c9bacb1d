"""Properties that hold for any rows, on small random tables."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfline.operators import money
from shelfline.operators.quality import ORDER_CHECKS, enforce, metrics, rejects
from shelfline.plans import gold, silver
from shelfline.streaming.changes import ChangeTable

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
cents = st.integers(-(10**13), 10**13)


@few
@given(st.lists(st.tuples(st.integers(0, 2), st.none() | cents), max_size=40))
def test_totals_and_means_are_exact(spark, rows):
    table = spark.createDataFrame([(g, None if c is None else c / 100) for g, c in rows], "g int, x double")
    got = {
        r.g: r
        for r in table.repartition(3)
        .groupBy("g")
        .agg(money.exact_total("x").alias("t"), money.rounded_mean("x").alias("m"), F.count("x").alias("n"))
        .collect()
    }
    for group in {g for g, _ in rows}:
        values = [Decimal(c) / 100 for g, c in rows if g == group and c is not None]
        assert got[group].n == len(values)
        if not values:
            assert got[group].t is None and got[group].m is None
            continue
        assert got[group].t == sum(values)
        exact = (sum(values) / len(values)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert got[group].m == float(exact)


@few
@given(st.lists(st.tuples(st.integers(1, 10**14), st.integers(-6, 4)), min_size=1, max_size=30))
def test_amounts_of_all_sizes_add_up(spark, parts):
    amounts = [Decimal(digits).scaleb(power) for digits, power in parts]
    table = spark.createDataFrame([(float(a),) for a in amounts], "x double")
    got = table.repartition(3).agg(money.exact_total("x").alias("t"), money.total("x").alias("d")).first()
    assert got.t == sum(amounts) and got.d == float(sum(amounts))


order_rows = st.lists(
    st.tuples(
        st.none() | st.sampled_from(["O1", "O2", "O3"]),
        st.none() | st.sampled_from(["C1", "C2"]),
        st.none() | st.sampled_from([-1.0, 0.0, 2.5, float("nan")]),
        st.none() | st.sampled_from(["completed", "odd"]),
    ),
    max_size=25,
)


@few
@given(order_rows)
def test_every_row_is_kept_or_rejected_and_counted(spark, rows):
    table = spark.createDataFrame(rows, "order_id string, customer_id string, total_amount double, status string")
    kept, rejected = enforce(table, ORDER_CHECKS), rejects(table, ORDER_CHECKS)
    assert kept.count() + rejected.count() == len(rows)
    assert rejected.filter(F.size("reasons") == 0).isEmpty()
    for line in metrics(table, "t", ORDER_CHECKS).collect():
        assert line.passed + line.failed == len(rows)


change_rows = st.lists(
    st.tuples(st.sampled_from("ABC"), st.sampled_from(["insert", "update", "delete"])), min_size=1, max_size=12
)


@few
@given(change_rows, st.randoms(use_true_random=False), st.integers(1, 4))
def test_changes_in_any_order_and_batches_give_one_state(spark, rows, rng, size):
    from shelfline.session import shared_dir

    changes = [(key, f"{key}{version}", kind, version) for version, (key, kind) in enumerate(rows)]
    want = {}
    for key, name, kind, _ in changes:
        want.pop(key, None)
        if kind != "delete":
            want[key] = name
    rng.shuffle(changes)
    ddl = "customer_id string, name string, _change_type string, _commit_version bigint"
    whole = spark.createDataFrame(changes, ddl).withColumn("_ingestion_ts", F.current_timestamp())
    assert {r.customer_id: r.name for r in silver.silver_customers(whole).collect()} == want
    table = ChangeTable(spark, shared_dir(spark, "changes"))
    for batch, start in enumerate(range(0, len(changes), size * 3)):
        table.write_batch(
            spark.createDataFrame(changes[start : start + size * 3], ddl).withColumn("_ingestion_ts", F.lit(batch)),
            batch,
        )
        if rng.random() < 0.5:
            table.fold()
    assert {r.customer_id: r.name for r in table.current().collect()} == want


session_rows = st.lists(
    st.tuples(
        st.sampled_from(["S1", "S2"]),
        st.sampled_from(["C1", "C2"]),
        st.sampled_from(["add_to_cart", "purchase", "search"]),
        st.integers(0, 4000),
    ),
    max_size=20,
)


@few
@given(session_rows)
def test_sessions_match_plain_python(spark, rows):
    table = spark.createDataFrame(
        rows, "session_id string, customer_id string, event_type string, s int"
    ).withColumn("event_ts", F.timestamp_seconds("s"))
    got = {(r.session_id, r.customer_id): r for r in gold.gold_cart_abandonment(table.drop("s")).collect()}
    groups = {}
    for session, customer, kind, second in rows:
        groups.setdefault((session, customer), []).append((kind, second))
    assert set(got) == set(groups)
    for key, events in groups.items():
        kinds, seconds = {k for k, _ in events}, [s for _, s in events]
        assert got[key].event_count == len(events)
        assert got[key].abandoned == ("add_to_cart" in kinds and "purchase" not in kinds)
        minutes = Decimal(max(seconds) - min(seconds)) / 60
        assert got[key].duration_mins == float(minutes.quantize(Decimal("0.1"), ROUND_HALF_UP))
