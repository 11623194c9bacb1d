from types import SimpleNamespace

import pytest

from shelfline.session import shared_dir


def session(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_folder_of_the_cluster_is_used():
    spark = session("spark://host:7077", spark_checkpoint_dir="hdfs://shared/dir/")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith("hdfs://shared/dir/x-") and first != second


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(RuntimeError):
        shared_dir(session("spark://host:7077"), "x")


def test_a_local_session_may_use_its_own():
    spark = session("local[2]")
    first, second = shared_dir(spark, "a"), shared_dir(spark, "b")
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_shuffle_files_are_gone_when_a_stored_table_is_written(spark, tmp_path, settings):
    from shelfline import samples
    from shelfline.session import SHUFFLE_CLEANUP, clean_up_shuffles
    from shelfline.streaming import refresh

    settings(**{SHUFFLE_CLEANUP.replace(".", "__"): "false"})
    clean_up_shuffles(spark)
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"  # what the session says stays
    spark.conf.unset(SHUFFLE_CLEANUP)
    samples.land_sample_feeds(spark, f"{tmp_path}/in", 20, 10, 100, 100, 20)
    known = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    before = known.size()
    refresh.refresh(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert known.size() <= before and spark.conf.get(SHUFFLE_CLEANUP) == "true"
