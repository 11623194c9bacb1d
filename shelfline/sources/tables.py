"""Stored tables: every write makes a new version folder, readers take the newest finished one.

A version becomes visible when its ready mark exists, which is set after the files are committed
and after the caller's check has passed. Nothing is overwritten, so a reader never meets a
half-written table and a job that dies leaves the last good version in place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

READY = "_READY"
# How the files of stored tables are compressed.
COMPRESSION = "zstd"


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, sorted."""
    fs, target = _path(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def mark(spark: SparkSession, path: str, name: str = READY) -> None:
    fs, target = _path(spark, f"{path}/{name}")
    fs.create(target, True).close()


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; its parent folders are made."""
    fs, path = _path(spark, target)
    fs.mkdirs(path.getParent())
    if not fs.rename(_path(spark, source)[1], path):
        raise OSError(f"{source} could not be moved to {target}")


def fingerprint(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """(bytes, files, newest change) of a table's files, to notice that a source has changed."""
    fs, target = _path(spark, path)
    summary = fs.getContentSummary(target)
    return summary.getLength(), summary.getFileCount(), fs.getFileStatus(target).getModificationTime()


def versions(spark: SparkSession, root: str) -> list[str]:
    """Finished version folders, oldest first."""
    return [f"{root}/{v}" for v in folders(spark, root) if exists(spark, f"{root}/{v}/{READY}")]


def write_version(
    df: DataFrame,
    root: str,
    partition_by: str | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Store ``df`` as the next version of the table at ``root`` and return it as stored.

    ``check`` looks at the written files and raises to keep the version invisible. A partitioned
    table is rebalanced on its partition column first: adaptive execution then splits a partition
    that holds many rows over several tasks and joins small ones, instead of one file per task.
    """
    spark = df.sparkSession
    known = folders(spark, root)
    number = int(known[-1][1:]) + 1 if known else 1
    path = f"{root}/v{number:08d}"
    if partition_by:
        df.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(path, compression=COMPRESSION)
    else:
        df.write.parquet(path, compression=COMPRESSION)
    stored = spark.read.parquet(path)
    if check:
        check(stored)
    mark(spark, path)
    return stored


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """Snapshot of the newest finished version."""
    found = versions(spark, root)
    if not found:
        raise FileNotFoundError(f"no finished version of {root}")
    return spark.read.parquet(found[-1])


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete finished versions but the newest ``keep``, and what failed before the newest; returns what was deleted."""
    finished = versions(spark, root)
    if keep <= 0 or not finished:
        return []
    failed = [p for p in (f"{root}/{v}" for v in folders(spark, root)) if p not in finished and p < finished[-1]]
    old = sorted([*finished[:-keep], *failed])
    for path in old:
        remove(spark, path)
    return old
