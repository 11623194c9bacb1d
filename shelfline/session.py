"""Sessions and the shared folder used for written tables and checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own_dirs: dict[str, str] = {}

# Deletes the shuffle files of a query when it ends; else they stay until the driver's memory is next collected.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str = "shelfline", master: str = "local[*]", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def clean_up_shuffles(spark: SparkSession) -> None:
    """Let the session delete shuffle files at the end of each query, unless it says otherwise.

    A query that runs a second time on the same DataFrame shuffles again.
    """
    if spark.conf.get(SHUFFLE_CLEANUP, None) is None:
        spark.conf.set(SHUFFLE_CLEANUP, "true")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder that every executor can reach, below ``spark.checkpoint.dir``.

    Where the setting is absent only a local master may fall back to a folder of its own:
    on a cluster a machine-local folder would be lost with the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        app = context.applicationId
        if app not in _own_dirs:
            _own_dirs[app] = tempfile.mkdtemp(prefix="shelfline-")
        root = _own_dirs[app]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
