import pytest
from pyspark.sql import functions as F

from shelfline.plans import serving
from shelfline.sources import tables


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, d int, v double")


def test_publish_and_status(spark, scratch):
    source = table(spark, [("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0)])
    copy = serving.publish(source, f"{scratch}/t_synced", ["k", "d"])
    status = serving.publish_status("t", source, copy, ["k", "d"]).head()
    assert (status.source_rows, status.copy_rows, status.state) == (3, 3, "ONLINE")
    assert serving.published_tables(spark, scratch) == ["t_synced"]
    other = source.withColumn("k", F.concat("k", F.lit("x")))
    assert serving.publish_status("t", other, copy, ["k", "d"]).head().state == "FAILED"
    assert serving.publish_status("t", source.limit(2), copy, ["k", "d"]).head().state == "FAILED"


@pytest.mark.parametrize(
    "rows, keys",
    [
        ([("a", 1, 1.0), ("a", 1, 2.0)], ["k", "d"]),
        ([("a", 1, 1.0), (None, 1, 2.0)], ["k", "d"]),
        ([("a", 1, 1.0), ("a", 2, 2.0)], ["k"]),
        ([(None, 1, 1.0)], ["k"]),
    ],
)
def test_broken_key_never_becomes_visible(spark, scratch, rows, keys):
    root = f"{scratch}/t"
    serving.publish(table(spark, [("good", 0, 0.0)]), root, keys)
    with pytest.raises(serving.KeyViolation):
        serving.publish(table(spark, rows), root, keys)
    assert [r.k for r in tables.read_latest(spark, root).collect()] == ["good"]
    # The next good publish is not disturbed by the failed one.
    serving.publish(table(spark, [("better", 0, 0.0)]), root, keys)
    assert [r.k for r in tables.read_latest(spark, root).collect()] == ["better"]


def test_key_faults_count_rows_and_keys(spark):
    rows = [("a", 1, 0.0)] * 3 + [("b", 1, 0.0), (None, 1, 0.0), (None, 1, 0.0)]
    assert tuple(serving.key_faults(table(spark, rows), ["k"]).head()) == (2, 1)


def test_empty_table_can_be_published(spark, scratch):
    source = table(spark, [])
    copy = serving.publish(source, f"{scratch}/t", ["k"])
    assert serving.publish_status("t", source, copy, ["k"]).head().state == "ONLINE"


def test_versions(spark, scratch):
    for value in (1.0, 2.0, 3.0):
        tables.write_version(table(spark, [("a", 1, value)]), scratch)
    assert tables.read_latest(spark, scratch).head().v == 3.0
    assert len(tables.drop_old_versions(spark, scratch, keep=1)) == 2
    assert tables.read_latest(spark, scratch).head().v == 3.0
    with pytest.raises(FileNotFoundError):
        tables.read_latest(spark, f"{scratch}/none")
