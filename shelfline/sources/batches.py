"""Tables that are filled by micro-batches, each of which appears whole or not at all.

A batch is written below ``_staging``, which no reader lists, and moved to its numbered folder when it is complete. A
batch that is handed over again finds its folder and is left alone, so a replay changes nothing. The rows of a batch may be
split over several tables in one write, see :meth:`BatchTable.adopt`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.sources import tables

BATCH = "batch"


class BatchTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def folder(self, number: int) -> str:
        return f"{self.root}/{BATCH}={number:012d}"

    def staging(self, number: int) -> str:
        return f"{self.root}/_staging/{BATCH}={number:012d}"

    def holds(self, number: int) -> bool:
        return tables.exists(self.spark, self.folder(number))

    def declare(self, rows: DataFrame) -> None:
        """Store the columns, so that the table can be read before its first row."""
        path = f"{self.root}/_columns"
        if not tables.exists(self.spark, f"{path}/{tables.READY}"):
            rows.limit(0).write.mode("overwrite").parquet(path)
            tables.mark(self.spark, path)

    def adopt(self, path: str, number: int) -> None:
        """Take over a folder of written files as a batch; there may be none where a batch has no rows."""
        if not self.holds(number) and tables.exists(self.spark, path):
            tables.move(self.spark, path, self.folder(number))

    def write(self, rows: DataFrame, number: int) -> None:
        """Store a micro-batch (the writer of a ``foreachBatch`` stream)."""
        if not self.holds(number):
            self.declare(rows)
            rows.write.mode("overwrite").parquet(self.staging(number), compression=tables.COMPRESSION)
            self.adopt(self.staging(number), number)

    def numbers(self) -> list[int]:
        """Numbers of the stored batches, in order."""
        found = [name for name in tables.folders(self.spark, self.root) if name.startswith(f"{BATCH}=")]
        return [int(name.split("=")[1]) for name in found]

    def read(self, after: int = -1, upto: int | None = None) -> DataFrame:
        """Rows of the batches later than ``after``, up to ``upto``; those of others are not listed in the scan."""
        if not self.numbers():
            return self.spark.read.parquet(f"{self.root}/_columns")
        rows = self.spark.read.parquet(self.root)
        if after >= 0:
            rows = rows.filter(F.col(BATCH) > after)
        if upto is not None:
            rows = rows.filter(F.col(BATCH) <= upto)
        return rows.drop(BATCH)
