"""Rows and files that break a job or slip through it unseen."""

import datetime as dt
import hashlib
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfline.functions import governance
from shelfline.operators import money, quality
from shelfline.plans import bi, conversations, serving, silver
from shelfline.sources import landing, tables
from shelfline.sources.batches import BatchTable
from shelfline.streaming import ingest

TURNS = "conv_id long, turn long, role string, content string"


def test_deletion_takes_messages_without_a_turn(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, None, "user", "b"), (2, None, "user", "c")], TURNS)
    deleted = spark.createDataFrame([(1,)], "conv_id long")
    assert [r.content for r in conversations.without_messages(turns, deleted).collect()] == ["c"]


def test_prompts_keep_messages_without_a_turn(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, None, "user", "b"), (1, 1, "user", "c")], TURNS)
    rows = conversations.packed_prompts(turns, turns_per_part=1).collect()
    assert sorted(r.part for r in rows) == [-1, 0, 1]


@pytest.mark.parametrize("country", ["Cote d'Ivoire", "x' OR 'a'='a", "back\\slash"])
def test_registered_filter_takes_the_name_as_it_is(spark, country):
    members = spark.createDataFrame([], "principal string, `group` string")
    governance.GovernedReader("someone", members, {}).register(spark, country)
    rows = spark.createDataFrame([(country,), ("Germany",)], "ship_country string")
    rows.createOrReplaceTempView("countries")
    found = spark.sql("SELECT ship_country FROM countries WHERE filter_by_country(ship_country)").collect()
    assert [r.ship_country for r in found] == [country]


@pytest.mark.parametrize(
    "rows, amount, want",
    [(1_000_000, "0.00004D", 40.0), (3_000_000, "8e14D", 2.4e21), (2, "if(id = 0, 1e15D, 5D)", 1e15 + 5)],
)
def test_no_amount_is_too_small_or_too_large_to_add(spark, rows, amount, want):
    assert spark.range(rows).selectExpr(f"{amount} AS x").agg(money.rounded_total("x")).first()[0] == want


def test_moving_average_of_large_days(spark):
    days = "order_day date, total_revenue double"
    daily = spark.createDataFrame([(dt.date(2024, 1, 1), 2e14), (dt.date(2024, 1, 2), 4e14)], days)
    assert [r.moving_avg for r in bi.moving_average(daily).collect()] == [2e14, 3e14]


def test_amounts_that_cannot_be_added_are_rejected(spark):
    bronze = spark.createDataFrame(
        [("O1", "C1", "P1", "1", "1", a, "completed", "2024-01-01", "DE") for a in ("1e18", "NaN", "9e17")],
        "order_id string, customer_id string, product_id string, quantity string, unit_price string, "
        "total_amount string, status string, order_date string, ship_country string",
    ).withColumn("_ingestion_ts", F.current_timestamp())
    assert [r.total_amount for r in silver.silver_orders(bronze).collect()] == [9e17]
    rejected = quality.rejects(silver.typed_orders(bronze), quality.ORDER_CHECKS).collect()
    assert [r.reasons for r in rejected] == [["positive_amount"]] * 2


def test_types_of_a_first_delivery_do_not_bind_later_ones(spark, scratch):
    def land(number, amount, bonus):
        text = f"order_id,total_amount,order_date,bonus\n0{number},{amount},2024-01-01,{bonus}"
        path = f"{scratch}/in/batch{number}"
        spark.createDataFrame([(text,)], "t string").coalesce(1).write.text(path)

    declared = StructType.fromDDL("order_id string, total_amount double, order_date string")
    for number, amount, bonus in ((1, "10", "1"), (2, "10.50", "2.5")):
        land(number, amount, bonus)
        schema = landing.remembered_schema(spark, f"{scratch}/schema", f"{scratch}/in", "csv", declared=declared)
        lines, table = ingest.bronze_stream(spark, f"{scratch}/in", "csv", schema), BatchTable(spark, f"{scratch}/out")
        write = lambda batch, n: table.write(ingest.csv_records(batch, schema), n)  # noqa: B023, E731
        ingest.wait([ingest.batch_stream(lines, write, f"{scratch}/log")])
    got = table.read().orderBy("order_id").collect()
    assert [(r.order_id, r.total_amount, float(r.bonus)) for r in got] == [("01", 10.0, 1.0), ("02", 10.5, 2.5)]
    assert all(r._corrupt_record is None for r in got)


def test_failed_copies_are_dropped_with_old_ones(spark, scratch):
    good = spark.createDataFrame([(1, 2.0)], "k long, v double")
    bad = spark.createDataFrame([(None, 2.0)], "k long, v double")
    for _ in range(2):
        with pytest.raises(serving.KeyViolation):
            serving.publish(bad, scratch, ["k"])
    for _ in range(3):
        serving.publish(good, scratch, ["k"])
    tables.drop_old_versions(spark, scratch, keep=1)
    assert tables.folders(spark, scratch) == ["v00000005"]


def test_a_copy_with_another_value_has_failed(spark):
    source = spark.createDataFrame([(1, 2.0)], "k long, v double")
    stale = spark.createDataFrame([(1, 3.0)], "k long, v double")
    state = lambda copy: serving.publish_status("t", source, copy, ["k"]).first().state
    assert (state(source), state(stale)) == ("ONLINE", "FAILED")


def test_stale_ranges_name_where_a_copy_differs(spark):
    source = spark.range(2000).selectExpr("id AS k", "CAST(id AS DOUBLE) + 1 AS v")
    changed = source.withColumn("v", F.when(F.col("k") == 77, 0.0).otherwise(F.col("v"))).filter("k <> 1234")
    found = serving.stale_ranges("t", source, changed, ["k"]).collect()
    assert {r.state for r in found} == {"FAILED"} and len(found) == 2
    by_range = {hashlib.md5(str(k).encode()).hexdigest()[:2] for k in (77, 1234)}
    assert {r.range for r in found} == by_range
    assert sum(r.source_rows - r.copy_rows for r in found) == 1 and sum(r.source_rows for r in found) < 60
    same = serving.stale_ranges("t", source, source, ["k"]).collect()
    assert [(r.state, r.range, r.source_rows, r.copy_rows) for r in same] == [("ONLINE", None, 2000, 2000)]
    none = serving.stale_ranges("t", source.limit(0), source.limit(0), ["k"]).collect()
    assert [(r.state, r.source_rows) for r in none] == [("ONLINE", 0)]


def test_a_file_of_an_old_date_is_read(spark, scratch):
    def run():
        rows = ingest.bronze_stream(spark, f"{scratch}/in", "parquet", spark.range(1).schema)
        ingest.wait([ingest.append_stream(rows, f"{scratch}/out", f"{scratch}/log")])
        return spark.read.parquet(f"{scratch}/out").count()

    spark.range(3).coalesce(1).write.parquet(f"{scratch}/in")
    assert run() == 3
    spark.range(2).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    newest = max((os.path.join(f"{scratch}/in", f) for f in os.listdir(f"{scratch}/in")), key=os.path.getmtime)
    files = [f for f in os.listdir(f"{scratch}/in") if f.endswith(".parquet")]
    second = max((f"{scratch}/in/{f}" for f in files), key=os.path.getctime)
    old = time.time() - 30 * 86400
    os.utime(second, (old, old))
    assert newest and run() == 5
