"""Streams give what batches give, whatever the cut into deliveries, and repeat nothing."""

import datetime as dt
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfline import samples, schemas
from shelfline.operators import dates, quality
from shelfline.operators.quality import ORDER_CHECKS
from shelfline.plans import bi, gold, silver
from shelfline.sources import generate as gen
from shelfline.sources import landing, tables
from shelfline.sources.batches import BatchTable
from shelfline.streaming import ingest, refresh
from shelfline.streaming.changes import ChangeTable

END = dt.datetime(2025, 1, 1)
TODAY = dt.date(2025, 1, 1)
N = 400


def feeds(spark):
    ids = gen.ids(spark, N)
    return {
        "orders": gen.orders(ids, N, END, 40, 20),
        "products": gen.products(gen.ids(spark, 20)),
        "clicks": gen.clicks(ids, N, END, 40, 20, 50),
        "customers": gen.customers(gen.ids(spark, 40)),
    }


def land(rows, folder, number, orders):
    landing.write_csv(orders, f"{folder}/orders/batch{number}")
    landing.write_json(rows["clicks"], f"{folder}/clickstream/batch{number}")
    landing.write_json(rows["products"], f"{folder}/products/batch{number}")
    landing.write_parquet(rows["customers"], f"{folder}/customers/batch{number}")


def same(left, right, drop=("_ingestion_ts", "order_month", "session_month", "_corrupt_record", "_beyond")):
    left, right = left.drop(*drop), right.drop(*drop).select(*left.drop(*drop).columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture(scope="module")
def one_delivery(spark):
    from shelfline.session import shared_dir

    folder, root = shared_dir(spark, "landing"), shared_dir(spark, "store")
    rows = feeds(spark)
    land(rows, folder, 1, rows["orders"])
    return folder, root, refresh.refresh(spark, folder, root, TODAY)


def test_bronze_is_what_was_landed(spark, one_delivery):
    _, _, store = one_delivery
    rows = feeds(spark)
    bronze = store.read("bronze_orders")
    assert dict(bronze.dtypes)["quantity"] == "int" and dict(bronze.dtypes)["order_date"] == "timestamp"
    assert same(
        bronze.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd HH:mm:ss")),
        rows["orders"],
        drop=("_ingestion_ts", "_source_file", "_source_ts", "_corrupt_record", "_beyond"),
    )
    assert same(store.read("bronze_clickstream"), rows["clicks"])
    assert same(store.read("bronze_customers_cdc"), rows["customers"])
    assert bronze.filter("_source_file LIKE '%/orders/batch1/%' AND _source_ts <= _ingestion_ts").count() == N
    assert bronze.select("_ingestion_ts").distinct().count() == 1


def test_silver_streams_equal_batches(one_delivery):
    _, _, store = one_delivery
    assert same(store.read("silver_orders"), silver.silver_orders(store.read("bronze_orders")))
    assert same(store.read("silver_clickstream"), silver.silver_clickstream(store.read("bronze_clickstream")))
    assert same(store.read("silver_customers"), silver.silver_customers(store.read("bronze_customers_cdc")))
    assert store.read("silver_orders").filter("order_month IS NULL").count() == 0


def test_repeated_refresh_adds_nothing(spark, one_delivery):
    folder, root, _ = one_delivery
    store = refresh.refresh(spark, folder, root, TODAY)
    assert store.read("bronze_orders").count() == N
    assert store.read("silver_clickstream").count() == N
    assert store.read("gold_revenue_daily").agg(F.sum("order_count")).head()[0] == N


def test_deliveries_in_pieces_give_the_same_tables(spark, one_delivery, scratch):
    _, _, whole = one_delivery
    rows = feeds(spark)
    folder, root = f"{scratch}/landing", f"{scratch}/store"
    early, late = landing.split_arrivals(rows["orders"], F.col("order_id"), "O0000150")
    assert (early.count(), late.count()) == (150, N - 150)
    land(rows, folder, 1, early)
    refresh.refresh(spark, folder, root, TODAY)
    landing.write_csv(late.repartition(3), f"{folder}/orders/batch2")
    store = refresh.refresh(spark, folder, root, TODAY, max_bytes=10_000)
    for name in ("silver_orders", "gold_revenue_daily", "gold_top_products", "gold_customer_ltv"):
        assert same(store.read(name), whole.read(name)), name


def test_daily_revenue_is_refreshed_for_the_months_that_changed(spark, scratch, monkeypatch):
    rows = feeds(spark)
    folder, root = f"{scratch}/landing", f"{scratch}/store"
    may = F.col("order_date").like("2024-05%")
    late_may = may & F.col("ship_country").isin("US")
    land(rows, folder, 1, rows["orders"].filter(~late_may))
    refresh.refresh(spark, folder, root, TODAY)
    computed = []
    whole = gold.gold_revenue_daily
    monkeypatch.setattr(
        refresh.gold,
        "gold_revenue_daily",
        lambda orders: computed.append({r[0] for r in orders.select("order_month").distinct().collect()}) or whole(orders),
    )
    store = refresh.open_store(spark, root)
    assert refresh.changed_months(store, store.read("silver_orders")) == []
    refresh.refresh(spark, folder, root, TODAY)
    assert computed == []  # nothing new, nothing computed
    undated = rows["orders"].limit(3).withColumn("order_id", F.concat("order_id", F.lit("x")))
    late = rows["orders"].filter(late_may).unionByName(undated.withColumn("order_date", F.lit("no date")))
    landing.write_csv(late, f"{folder}/orders/batch2")
    store = refresh.refresh(spark, folder, root, TODAY)
    assert computed == [{dt.date(2024, 5, 1), None}]
    assert same(store.read("gold_revenue_daily"), whole(store.read("silver_orders")))
    assert store.read("gold_revenue_daily").filter("order_day IS NULL").agg(F.sum("order_count")).head()[0] == 3
    # More undated rows change the undated group only.
    landing.write_csv(
        undated.withColumn("order_id", F.concat("order_id", F.lit("y"))).withColumn("order_date", F.lit("none")),
        f"{folder}/orders/batch3",
    )
    store = refresh.refresh(spark, folder, root, TODAY)
    assert computed[1:] == [{None}]
    assert same(store.read("gold_revenue_daily"), whole(store.read("silver_orders")))


def test_full_refresh_makes_a_new_generation_beside_the_old(spark, scratch):
    rows = feeds(spark)
    folder, root = f"{scratch}/landing", f"{scratch}/store"
    land(rows, folder, 1, rows["orders"])
    first = refresh.refresh(spark, folder, root, TODAY)
    second = refresh.refresh(spark, folder, root, TODAY, full=True)
    assert first.path != second.path and refresh.open_store(spark, root).path == second.path
    assert same(first.read("gold_top_products"), second.read("gold_top_products"))
    # A generation that was never completed is not opened.
    tables.mark(spark, f"{root}/g000009/bronze")
    assert refresh.open_store(spark, root).path == second.path


def test_sample_feeds_and_sql_over_the_store(spark, scratch):
    samples.land_sample_feeds(spark, f"{scratch}/in", 50, 20, 600, 900, 100, END)
    store = refresh.refresh(spark, f"{scratch}/in", f"{scratch}/out", TODAY)
    assert spark.read.csv(f"{scratch}/in/orders/batch1", header=True).count() == 300
    assert "gold_customer_ltv" in store.create_views()
    totals = spark.sql("SELECT sum(order_count) n, sum(total_revenue) r FROM gold_revenue_daily").head()
    orders = spark.sql("SELECT count(*) n, sum(total_amount) r FROM silver_orders").head()
    assert totals.n == orders.n == 600 and totals.r == pytest.approx(orders.r)
    trend = spark.sql(
        "WITH w AS (SELECT date_trunc('week', order_day) week, sum(total_revenue) r FROM gold_revenue_daily GROUP BY 1) "
        "SELECT week, r, lag(r) OVER (ORDER BY week) before FROM w ORDER BY week DESC LIMIT 8"
    )
    assert [round(r.r, 2) for r in trend.collect()] == [
        r.weekly_revenue for r in bi.wow_revenue(store.read("gold_revenue_daily")).collect()
    ]
    assert store.read("silver_customers").count() == 50
    assert store.read("gold_cart_abandonment").agg(F.sum("event_count")).head()[0] == 900


def test_open_store_before_any_refresh(spark, scratch):
    with pytest.raises(FileNotFoundError):
        refresh.open_store(spark, scratch)


def careless(spark):
    feed = gen.orders(gen.ids(spark, 300), 300, END)
    odd = F.when(F.col("order_id") > "O0000250", -1.0).otherwise(F.col("total_amount"))
    nobody = F.when(F.col("order_id") > "O0000010", F.col("customer_id"))
    status = F.when(F.col("order_id") <= "O0000005", "odd").otherwise(F.col("status"))
    rows = feed.withColumns({"total_amount": odd, "customer_id": nobody, "status": status})
    return rows.withColumn("_ingestion_ts", F.current_timestamp())


def test_counts_and_rejects_of_many_micro_batches(spark, scratch):
    """150 micro-batches, each handed over twice, count every row once; kept and rejected rows come from one scan."""
    rows = careless(spark)
    store = refresh.Store(spark, scratch, "g000001")
    numbered = rows.withColumn("n", F.substring("order_id", 2, 7).cast("int") % 150).toPandas()
    write = refresh.checked(store, "silver_orders", silver.typed_orders, ORDER_CHECKS)
    for number, part in numbered.groupby("n"):
        batch = spark.createDataFrame(part.drop(columns="n"), rows.schema).coalesce(1)
        write(batch, int(number))
        if number % 10 == 0:
            write(batch, int(number))
    counted = quality.added_up(store.checks("silver_orders").read())
    whole = quality.metrics(silver.typed_orders(rows), "silver_orders", ORDER_CHECKS)
    assert same(counted, whole) and len(store.checks("silver_orders").numbers()) == 150
    kept = silver.silver_orders(rows)
    assert same(store.read("silver_orders"), kept) and 0 < kept.count() < 300
    rejected = quality.rejects(silver.typed_orders(rows), ORDER_CHECKS)
    assert same(store.read("silver_orders_rejects"), rejected) and rejected.count() == 60


def test_a_batch_that_was_stopped_is_done_again_as_a_whole(spark, scratch, monkeypatch):
    rows = careless(spark)
    store = refresh.Store(spark, scratch, "g000001")
    write = refresh.checked(store, "silver_orders", silver.typed_orders, ORDER_CHECKS)
    adopt = refresh.BatchTable.adopt

    def fails(table, path, number):
        if table.root.endswith("_rejects"):
            raise OSError("lost")
        adopt(table, path, number)

    monkeypatch.setattr(refresh.BatchTable, "adopt", fails)
    with pytest.raises(OSError):
        write(rows, 0)
    monkeypatch.setattr(refresh.BatchTable, "adopt", adopt)
    write(rows, 0)
    assert store.read("silver_orders").count() + store.read("silver_orders_rejects").count() == 300
    assert store.read("silver_orders_rejects").count() == 60
    assert store.checks("silver_orders").read().filter("constraint_name = 'positive_amount'").head().failed == 50


def test_one_scan_feeds_kept_rejected_and_counts(spark, scratch, monkeypatch):
    landing.write_parquet(careless(spark), f"{scratch}/bronze")
    store = refresh.Store(spark, scratch, "g000001")
    plans = []
    write = refresh.checked(store, "silver_orders", silver.typed_orders, ORDER_CHECKS)
    real = refresh.quality.observed
    monkeypatch.setattr(refresh.quality, "observed", lambda *a: plans.append(real(*a)) or plans[-1])
    write(spark.read.parquet(f"{scratch}/bronze"), 0)
    assert len(plans) == 1 and plan_of(plans[0]).count("FileScan parquet") == 1


def test_rejected_rows_are_kept_by_the_refresh(spark, one_delivery):
    _, _, store = one_delivery
    assert store.read("silver_orders_rejects").count() == 0
    assert store.read("silver_clickstream_rejects").count() == 0
    assert store.read("silver_checks").filter("dataset = 'silver_orders'").agg(F.max("passed")).head()[0] == N


def test_schema_is_inferred_once(spark, scratch):
    landing.write_json(spark.range(3).selectExpr("id", "1.5 AS price"), f"{scratch}/feed")
    first = landing.remembered_schema(spark, f"{scratch}/schema", f"{scratch}/feed", "json")
    landing.write_json(spark.range(3).selectExpr("id", "'x' AS price"), f"{scratch}/feed")
    assert landing.remembered_schema(spark, f"{scratch}/schema", f"{scratch}/feed", "json") == first
    assert first["price"].dataType.simpleString() == "double"


def read_csv(spark, path, schema, scratch, number=0):
    """CSV files as the order stream reads them."""
    table = BatchTable(spark, f"{scratch}/csv-{number}")
    lines = ingest.bronze_stream(spark, path, "csv", schema)
    writer = lambda batch, n: table.write(ingest.csv_records(batch, schema), n)
    ingest.wait([ingest.batch_stream(lines, writer, f"{scratch}/checkpoint-{number}")])
    return table.read()


def test_every_csv_file_has_a_header_of_its_own(spark, scratch):
    feed = gen.orders(gen.ids(spark, 5), 5, END)
    landing.write_csv(feed, f"{scratch}/in/batch1")
    later = feed.withColumn("order_id", F.concat("order_id", F.lit("x")))
    landing.write_csv(later.select(*reversed(feed.columns)), f"{scratch}/in/batch2")
    more = feed.withColumn("order_id", F.concat("order_id", F.lit("y"))).withColumn("note", F.lit('say "a,b"'))
    landing.write_csv(more.withColumn("rank", F.lit(None).cast("int")), f"{scratch}/in/batch3")
    landing.write_csv(feed.drop("ship_country").withColumn("order_id", F.concat("order_id", F.lit("z"))), f"{scratch}/in/batch4")
    schema = StructType.fromDDL(schemas.ORDERS)
    got = read_csv(spark, f"{scratch}/in", schema, scratch)
    assert got.filter("_corrupt_record IS NOT NULL").count() == 0
    for letter, rows in (("", feed), ("x", later), ("y", feed.withColumn("order_id", F.concat("order_id", F.lit("y"))))):
        part = got.filter(F.col("order_id").rlike(f"[0-9]{letter}$"))
        assert same(part.select(*feed.columns), rows), letter
    beyond = {r.order_id[-1]: r._beyond for r in got.collect()}
    assert beyond["y"] == '{"note":"say \\"a,b\\""}' and beyond["x"] is None and beyond["z"] is None
    assert got.filter("order_id LIKE '%z' AND ship_country IS NULL").count() == 5


def test_csv_lines_are_not_shuffled_to_meet_their_header(spark, scratch, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    schema = StructType.fromDDL("a string, b int, t timestamp")
    spark.createDataFrame([("b,x,a,x",), ("1,u,p,w",), ("a,b",), ("2",), (",,,",)], "value string").coalesce(1).write.text(scratch)
    lines = spark.read.text(scratch).select("value", F.col("_metadata.file_path").alias("_source_file"))
    read = ingest.csv_records(lines, schema)
    plan = plan_of(read)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    found = sorted((r.a or "", r.b or 0, r._corrupt_record or "", r._beyond or "") for r in read.collect())
    # "a,b" names two of three columns as well; the longer header counts.
    assert found == [("", 0, "", ""), ("", 2, "2", ""), ("p", 1, "", '{"x":"u"}')]


def test_csv_headers_are_looked_for_once(spark, scratch):
    spark.createDataFrame([("b,a",), ("1,u",)], "value string").coalesce(1).write.text(scratch)
    lines = spark.read.text(scratch).select("value", F.col("_metadata.file_path").alias("_source_file"))
    read = ingest.csv_records(lines, StructType.fromDDL("a string, b int"))
    assert plan_of(read).count("Scan text") == 1  # what cuts the lines does not look for the headers again
    assert [(r.a, r.b) for r in read.collect()] == [("u", 1)]


def test_a_csv_file_without_header_has_the_declared_order(spark, scratch):
    spark.createDataFrame([("1,2.5",), ("2,",), ("",)], "t string").coalesce(1).write.text(f"{scratch}/in")
    got = read_csv(spark, f"{scratch}/in", StructType.fromDDL("id int, amount double"), scratch)
    assert {(r.id, r.amount, r._corrupt_record) for r in got.collect()} == {(1, 2.5, None), (2, None, None)}


def test_fields_beyond_the_schema_are_kept_with_their_types(spark, scratch):
    lines = ['{"id": 1, "tags": ["a", {"b": 2.50}], "n": null}', '{"id": 2}', '{"id": "x", "more": true}', "{broken"]
    spark.createDataFrame([(line,) for line in lines], "t string").write.text(f"{scratch}/json")
    rows = ingest.bronze_stream(spark, f"{scratch}/json", "json", StructType.fromDDL("id int"))
    ingest.wait([ingest.append_stream(rows, f"{scratch}/out", f"{scratch}/checkpoint")])
    got = {(r.id, r._beyond, r._corrupt_record) for r in spark.read.parquet(f"{scratch}/out").collect()}
    assert got == {
        (1, '{"tags":["a",{"b":2.5}],"n":null}', None),
        (2, None, None),
        (None, '{"more":true}', lines[2]),
        (None, None, lines[3]),
    }


def test_times_in_later_spellings_are_times(spark, scratch):
    spellings = ["2024-05-03 10:20:30", "03.05.2024 10:20:30", "2024/05/03 10:20", "3 May 2024", "05/03/2024", "20240503", "soon"]
    rows = [(f"O{i},C1,P1,1,2.0,2.0,completed,{time},US",) for i, time in enumerate(spellings)]
    header = (schemas.ORDERS.replace(" string", "").replace(" int", "").replace(" double", "").replace(" ", ""),)
    spark.createDataFrame([header, *rows], "t string").coalesce(1).write.text(f"{scratch}/in")
    declared = StructType.fromDDL(schemas.ORDERS.replace("order_date string", "order_date timestamp"))
    got = {r.order_id: (r.order_date, r._corrupt_record) for r in read_csv(spark, f"{scratch}/in", declared, scratch).collect()}
    assert all(got[f"O{i}"][0].date() == dt.date(2024, 5, 3) and got[f"O{i}"][1] is None for i in range(6))
    assert got["O6"] == (None, rows[6][0])
    as_text = read_csv(spark, f"{scratch}/in", StructType.fromDDL(schemas.ORDERS), scratch, 1)
    daily = gold.gold_revenue_daily(silver.silver_orders(as_text.withColumn("_ingestion_ts", F.current_timestamp())))
    assert {(r.order_day, r.order_count) for r in daily.collect()} == {(dt.date(2024, 5, 3), 6), (None, 1)}


def test_no_time_is_lost_by_trying_only_spellings_whose_marks_are_there(spark):
    texts = ["2024-05-03", "2024-05-03T10:20:30", "2024/05/03", "2024/05/03 10:20:30", "03.05.2024 10:20", "3 May 2024", "3 may 2024 10:20"]
    texts += ["May 3, 2024", "MAY 3, 2024 10:20:30", "05/03/2024 10:20", "20240503", "20240503 102030", "+20240503", "12:30", "1.5", "2024", " "]
    rows = spark.createDataFrame([(text,) for text in [*texts, "a/b.c, d", "99/99/2024", "31.02.2024", None]], "t string")
    plain = F.trim("t")
    iso = F.when(~plain.rlike(r"^\d{5,}"), plain.try_cast("timestamp"))
    all_tried = F.coalesce(iso, *[F.try_to_timestamp(plain, F.lit(spelling)) for spelling in dates.SPELLINGS])
    read = rows.select("t", dates.read_time(F.col("t")).alias("got"), all_tried.alias("wanted"))
    assert read.filter("NOT (got <=> wanted)").collect() == [] and read.filter("got IS NOT NULL").count() >= 12


def test_records_that_do_not_fit_keep_their_text(spark, scratch):
    spark.createDataFrame([("id,amount\n1,2.5\n2,oops\n3,4.5,extra",)], "t string").coalesce(1).write.text(f"{scratch}/csv")
    spark.createDataFrame([('{"id": 1}',), ('{"id": "x"}',), ("{broken",)], "t string").write.text(f"{scratch}/json")
    schema = StructType.fromDDL("id int, amount double")
    got = read_csv(spark, f"{scratch}/csv", schema, scratch)
    assert got.count() == 3
    assert {r[0] for r in got.filter("_corrupt_record IS NOT NULL").select("_corrupt_record").collect()} == {"2,oops", "3,4.5,extra"}
    rows = ingest.bronze_stream(spark, f"{scratch}/json", "json", schema)
    ingest.wait([ingest.append_stream(rows, f"{scratch}/json-out", f"{scratch}/json-checkpoint")])
    got = spark.read.parquet(f"{scratch}/json-out")
    assert {r[0] for r in got.filter("_corrupt_record IS NOT NULL").select("_corrupt_record").collect()} == {'{"id": "x"}', "{broken"}


def test_lines_added_up_once_are_the_parts_that_orders_and_sessions_are_reduced_to(spark):
    day = dt.datetime(2024, 5, 6, 7, 8, 9)
    rows = [("p1", "o1", "c1", 2, 10.5, "returned", day), ("p1", "o1", "c1", None, None, "completed", day), (None, "o2", "c1", None, 0.1, None, None)]
    rows += [("p2", None, None, 3, 1 / 3, "pending", None), ("p2", None, None, 3, 1 / 3, "pending", day), ("p1", "o1", "c1", 2, 10.5, "returned", day)]
    names = "product_id string, order_id string, customer_id string, quantity int, total_amount double, status string, order_date timestamp"
    orders = spark.createDataFrame(rows, names)
    added, reduced = gold.added_product_orders(gold.product_lines(orders)), gold.product_orders(orders)
    assert added.dtypes == reduced.dtypes and same(added, reduced)
    added, reduced = gold.added_customer_orders(gold.customer_lines(orders)), gold.customer_orders(orders)
    assert added.dtypes == reduced.dtypes and same(added, reduced)
    seen = [("s1", "c1", "add_to_cart", day), ("s1", "c1", None, None), ("s1", None, "purchase", day), (None, None, "search", None)]
    clicks = spark.createDataFrame(seen, "session_id string, customer_id string, event_type string, event_ts timestamp")
    added, reduced = gold.merged_sessions(gold.session_clicks(clicks)), gold.session_parts(clicks)
    assert added.dtypes == reduced.dtypes and same(added, reduced)


def test_one_new_click_file_reads_and_writes_only_the_buckets_of_its_sessions(spark, scratch):
    store = refresh.Store(spark, scratch, "g000001")
    clicks = gen.clicks(gen.ids(spark, N), N, END, 40, 20, 50).withColumn("_ingestion_ts", F.current_timestamp())
    table = store.batches("silver_clickstream")
    table.write(silver.silver_clickstream(clicks), 0)
    refresh.refresh_sessions(store)
    state = store.state("gold_cart_abandonment")
    before = {b: state.paths("sessions", [b]) for b in range(state.buckets)}
    one = clicks.limit(1).select(*clicks.columns).withColumn("event_id", F.lit("new")).withColumn("ts", F.lit("2031-01-01 00:00:00"))
    table.write(silver.silver_clickstream(one), 1)
    new = gold.session_parts(table.read(after=0))
    assert len(table.read(after=0).select("event_id").collect()) == 1
    touched = state.touched(new)
    assert len(touched) == 1
    assert set(state.read("sessions", touched).inputFiles()) < set(state.read("sessions").inputFiles())
    assert all(f"bucket={touched[0]}/" in path for path in state.read("sessions", touched).inputFiles())
    assert refresh.refresh_sessions(store) == touched
    after = {b: state.paths("sessions", [b]) for b in range(state.buckets)}
    assert [b for b in before if before[b] != after[b]] == touched
    both = clicks.unionByName(one)
    assert same(store.read("gold_cart_abandonment"), gold.gold_cart_abandonment(silver.silver_clickstream(both)))
    assert refresh.refresh_sessions(store) == []
    state.drop_unused(keep=1)
    assert same(store.read("gold_cart_abandonment"), gold.gold_cart_abandonment(silver.silver_clickstream(both)))


def test_orders_that_are_delivered_again_are_counted_once(spark, scratch):
    store = refresh.Store(spark, scratch, "g000001")
    orders = silver.silver_orders(gen.orders(gen.ids(spark, 200), 200, END, 40, 20).withColumn("_ingestion_ts", F.current_timestamp()))
    customers = gen.customers(gen.ids(spark, 40))
    products = silver.silver_products(gen.products(gen.ids(spark, 20)).withColumn("_ingestion_ts", F.current_timestamp()))
    table = store.batches("silver_orders")
    parts = [orders.filter("order_id <= 'O0000120'"), orders.filter("order_id > 'O0000100'"), orders.filter("order_id = 'O0000007'")]
    seen = None
    for number, part in enumerate(parts):
        table.write(part, number)
        seen = part if seen is None else seen.unionByName(part)
        touched = refresh.refresh_product_totals(store), refresh.refresh_customer_totals(store)
        sold, bought = (store.state(n).read("totals") for n in ("gold_top_products", "gold_customer_ltv"))
        assert same(gold.described_products(sold, products), gold.gold_top_products(seen, products))
        current = silver.silver_customers(customers.withColumn("_ingestion_ts", F.current_timestamp()))
        assert same(gold.valued_customers(current, bought, TODAY), gold.gold_customer_ltv(current, seen, TODAY))
    assert [len(t) for t in touched] == [1, 1]
    assert gold.described_products(sold, products).agg(F.sum("orders_count")).head()[0] == 200


def test_text_lands_compressed_in_files_of_bounded_length(spark, scratch, monkeypatch):
    rows = spark.range(250, numPartitions=1).selectExpr("id", "concat('x, ', id) AS name")
    monkeypatch.setitem(landing.TEXT_FILES, "maxRecordsPerFile", "100")
    landing.write_csv(rows, f"{scratch}/csv")
    landing.write_json(rows, f"{scratch}/json")
    for fmt, ending in (("csv", ".csv.gz"), ("json", ".json.gz")):
        found = spark.read.options(**landing.READ_OPTIONS[fmt]).schema("id bigint, name string").format(fmt).load(f"{scratch}/{fmt}")
        assert len(found.inputFiles()) == 3 and all(path.endswith(ending) for path in found.inputFiles())
        assert same(found, rows)


def test_replaced_buckets_that_no_reader_takes_are_deleted(spark, scratch):
    store = refresh.Store(spark, scratch, "g000001")
    orders = silver.silver_orders(gen.orders(gen.ids(spark, 200), 200, END, 40, 20).withColumn("_ingestion_ts", F.current_timestamp()))
    table = store.batches("silver_orders")
    for number, part in enumerate(("order_id <= 'O0000120'", "order_id > 'O0000100'", "order_id = 'O0000007'")):
        table.write(orders.filter(part), number)
        refresh.refresh_product_totals(store)
        state = store.state("gold_top_products")
        for part in ("orders", "totals"):
            data = f"{state.root}/data/{part}"
            buckets = [f"{data}/{c}/{b}" for c in tables.folders(spark, data) for b in tables.folders(spark, f"{data}/{c}")]
            assert sorted(buckets) == sorted(state.paths(part))
        assert len(tables.versions(spark, f"{state.root}/manifests")) == 1
    assert state.read("orders").agg(F.sum("lines")).head()[0] == 200 + 20 + 1


def test_generations_are_compared_row_by_row_only_in_parts_that_differ(spark, monkeypatch):
    class Generation:
        def __init__(self, rows):
            self.rows = rows

        def read(self, name):
            return self.rows

    monkeypatch.setattr(refresh, "QUALITY", {"t": "silver"})
    rows = spark.range(20_000, numPartitions=4).selectExpr("id", "if(id % 5 = 0, NULL, id % 7) AS v", "id AS _ingestion_ts")
    one = rows.limit(1).selectExpr("-1L AS id", "NULL AS v", "0L AS _ingestion_ts")
    twice = rows.filter("id IN (3, 4)")
    for left, right, wanted in (
        (rows, rows.withColumn("_ingestion_ts", F.lit(0)), (0, 0)),
        (rows.unionByName(one), rows, (1, 0)),
        (rows.unionByName(twice), rows.unionByName(twice).unionByName(twice).unionByName(one), (0, 3)),
        (rows.filter("id <> 7"), rows.filter("id <> 8"), (1, 1)),
        (rows.limit(0), rows, (0, 20_000)),
    ):
        found = refresh.generation_difference(Generation(left), Generation(right))
        assert [tuple(r) for r in found.collect()] == [("t", *wanted)]
        parts = refresh.unlike_parts(refresh._sides(Generation(left), Generation(right), "t", ()))
        assert parts.count() <= sum(wanted) and (parts.count() == 0) == (wanted == (0, 0))


def test_declared_schemas_give_the_same_tables(spark, one_delivery, scratch):
    folder, _, whole = one_delivery
    store = refresh.refresh(spark, folder, scratch, TODAY, infer=False)
    assert dict(store.read("bronze_orders").dtypes)["order_date"] == "string"
    for name in ("silver_orders", "silver_clickstream", "silver_products", "silver_customers", "gold_customer_ltv"):
        assert same(store.read(name), whole.read(name)), name


def test_not_a_number_is_dropped_by_the_amount_check(spark, scratch):
    feed = gen.orders(gen.ids(spark, 3), 3, END)
    amounts = F.when(F.col("order_id") == "O0000002", float("nan")).when(F.col("order_id") == "O0000003", float("inf"))
    rows = feed.withColumn("total_amount", F.coalesce(amounts, "total_amount")).withColumn(
        "_ingestion_ts", F.current_timestamp()
    )
    assert [r.order_id for r in silver.silver_orders(rows).collect()] == ["O0000001"]


def test_continuous_streams_pick_up_new_files(spark, scratch):
    rows = feeds(spark)
    folder, root = f"{scratch}/landing", f"{scratch}/store"
    early, late = landing.split_arrivals(rows["orders"], F.col("order_id"), "O0000100")
    land(rows, folder, 1, early)
    store = refresh.refresh(spark, folder, root, TODAY)
    queries = refresh.start_continuous(store, folder, "1 second")
    try:
        landing.write_csv(late, f"{folder}/orders/batch2")
        for _ in range(4):
            for query in queries:
                query.processAllAvailable()
            if store.read("silver_orders").count() == N:
                break
        assert store.read("silver_orders").count() == N
    finally:
        for query in queries:
            query.stop()
    views = refresh.refresh_views(store, TODAY)
    assert views["gold_revenue_daily"].agg(F.sum("order_count")).head()[0] == N


# Change feed: key, name, change, version.
CHANGES = [
    ("A", "a1", "insert", 1),
    ("A", "a3", "update", 3),
    ("A", "a2", "update", 2),
    ("B", "b1", "insert", 1),
    ("B", "b5", "delete", 5),
    ("B", "b4", "update", 4),
    ("C", "c1", "insert", 1),
    ("C", "c2", "delete", 2),
    ("C", "c3", "insert", 3),
    ("D", "d1", "update", 1),
    ("D", "d1x", "delete", 1),
    ("E", "e1", "delete", 1),
]
CURRENT = {("A", "a3"), ("C", "c3")}


def changes(spark, rows):
    return spark.createDataFrame(
        rows, "customer_id string, name string, _change_type string, _commit_version bigint"
    ).withColumn("_ingestion_ts", F.current_timestamp())


def state(table):
    return {tuple(r) for r in table.current().collect()}


def test_changes_in_batch(spark):
    assert {tuple(r) for r in silver.silver_customers(changes(spark, CHANGES)).collect()} == CURRENT


@pytest.mark.parametrize("order", range(4))
def test_changes_in_any_order_and_cut(spark, scratch, order):
    rows = random.Random(order).sample(CHANGES, len(CHANGES))
    table = ChangeTable(spark, scratch)
    for batch, start in enumerate(range(0, len(rows), 5)):
        table.write_batch(changes(spark, rows[start : start + 5]), batch)
        if batch == 1:
            table.fold()
    assert state(table) == CURRENT
    table.fold()
    assert state(table) == CURRENT


def test_replayed_batch_changes_nothing(spark, scratch):
    table = ChangeTable(spark, scratch)
    table.write_batch(changes(spark, CHANGES[:6]), 0)
    table.fold()
    table.write_batch(changes(spark, CHANGES[6:]), 1)
    before = state(table)
    table.write_batch(changes(spark, CHANGES[6:]), 1)
    table.write_batch(changes(spark, CHANGES[:6]), 0)
    assert state(table) == before == CURRENT


def test_unfinished_pieces_are_ignored(spark, scratch):
    table = ChangeTable(spark, scratch)
    table.write_batch(changes(spark, CHANGES), 0)
    table.fold()
    lost = changes(spark, [("Z", "z", "insert", 1)])
    lost.write.parquet(table.batches.staging(1))
    table.state.write(table.state.start(), "newest", silver.newest_change(lost))
    assert state(table) == CURRENT
    table.write_batch(changes(spark, [("F", "f1", "insert", 1)]), 1)
    table.fold()
    assert state(table) == CURRENT | {("F", "f1")}


def test_one_change_rewrites_one_bucket(spark, scratch):
    table = ChangeTable(spark, scratch)
    table.write_batch(changes(spark, CHANGES), 0)
    assert len(table.fold()) > 1
    before = set(table.state.paths("newest"))
    table.write_batch(changes(spark, [("A", "a9", "update", 9)]), 1)
    assert len(table.fold()) == 1 and table.fold() == []
    assert len(before - set(table.state.paths("newest"))) == 1
    assert state(table) == {("A", "a9"), ("C", "c3")}


def test_folding_writer_and_clean_up(spark, scratch):
    table = ChangeTable(spark, scratch)
    write = table.writer(fold_every=3)
    for batch, row in enumerate(CHANGES):
        write(changes(spark, [row]), batch)
    assert state(table) == CURRENT
    table.drop_folded(keep=1)
    assert table.batches.numbers() == []
    assert len(tables.versions(spark, f"{table.state.root}/manifests")) == 1
    assert state(table) == CURRENT


def test_empty_change_table(spark, scratch):
    with pytest.raises(FileNotFoundError):
        ChangeTable(spark, scratch).current()


def test_late_update_after_a_fold_does_not_revive(spark, scratch):
    table = ChangeTable(spark, scratch)
    table.write_batch(changes(spark, [("A", "a1", "insert", 1), ("A", "a5", "delete", 5)]), 0)
    table.fold()
    table.write_batch(changes(spark, [("A", "a4", "update", 4)]), 1)
    assert state(table) == set()
    table.write_batch(changes(spark, [("A", "a6", "insert", 6)]), 2)
    assert state(table) == {("A", "a6")}
