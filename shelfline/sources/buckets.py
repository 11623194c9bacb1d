"""Stored state in hash buckets, of which a change rewrites only those it touches.

A state has named parts, each a table whose rows are dealt to ``buckets`` folders by a hash of their key. A change
writes the touched buckets of all parts into a new folder and then a new manifest, which says for every bucket in which
folder it is and up to which batch the state holds its source. The manifest becomes visible with its ready mark, so all
parts move on together and a change that dies leaves the last state in place. One writer owns a state.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import IntegerType, LongType, StructType

from shelfline.sources import tables

BUCKET, CHANGE = "bucket", "change"


class BucketState:
    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 16):
        self.spark = spark
        self.root = root
        self.keys = list(keys)
        self.buckets = buckets
        self._written: dict[str, str] = {}

    def _manifests(self) -> list[str]:
        return tables.versions(self.spark, f"{self.root}/manifests")

    def _manifest(self, path: str) -> dict:
        return json.loads(self.spark.read.text(path, wholetext=True).head()[0])

    def manifest(self) -> dict:
        """``upto``: the last batch of the source that the state holds; ``folders``: where each bucket is."""
        found = self._manifests()
        return self._manifest(found[-1]) if found else {"upto": -1, "buckets": self.buckets, "folders": {}, "schemas": {}}

    def upto(self) -> int:
        return self.manifest()["upto"]

    def oldest_upto(self) -> int:
        """The last batch that every kept manifest holds."""
        found = self._manifests()
        return self._manifest(found[0])["upto"] if found else -1

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.manifest()["buckets"])).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that hold the keys of some rows: at most as many values as there are buckets."""
        return sorted(row[0] for row in rows.select(self.bucket().alias(BUCKET)).distinct().collect())

    def paths(self, part: str, buckets: Sequence[int] | None = None) -> list[str]:
        folders = self.manifest()["folders"]
        wanted = folders if buckets is None else [str(b) for b in buckets if str(b) in folders]
        found = [f"{self._data(part)}/{CHANGE}={folders[b]}/{BUCKET}={b}" for b in wanted]
        return [path for path in found if tables.exists(self.spark, path)]

    def read(self, part: str, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """A part, or those buckets of it; None where nothing is stored."""
        paths = self.paths(part, buckets)
        if not paths:
            return None
        schema = StructType.fromJson(json.loads(self.manifest()["schemas"][part])).add(CHANGE, LongType()).add(BUCKET, IntegerType())
        reader = self.spark.read.schema(schema).option("basePath", self._data(part))
        return reader.parquet(*paths).drop(CHANGE, BUCKET)

    def _data(self, part: str) -> str:
        return f"{self.root}/data/{part}"

    def start(self) -> int:
        """The number of the next change: none that was begun before has it, finished or not."""
        data = f"{self.root}/data"
        known = [f for part in tables.folders(self.spark, data) for f in tables.folders(self.spark, f"{data}/{part}")]
        return max([int(f.split("=")[1]) for f in known], default=0) + 1

    def write(self, change: int, part: str, rows: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Write the touched buckets of a part and return them as written."""
        path = f"{self._data(part)}/{CHANGE}={change}"
        by = [BUCKET, *([partition_by] if partition_by else [])]
        dealt = rows.withColumn(BUCKET, self.bucket())
        dealt.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path, compression=tables.COMPRESSION)
        self._written[part] = rows.schema.json()
        return self.spark.read.schema(dealt.schema).parquet(path).drop(BUCKET)

    def commit(self, change: int, touched: Sequence[int], upto: int) -> None:
        """Make the new buckets visible."""
        state = self.manifest()
        state["folders"] |= {str(b): change for b in touched}
        state["schemas"] |= self._written
        state["upto"] = upto
        text = self.spark.createDataFrame([(json.dumps(state),)], "state string")
        known = tables.folders(self.spark, f"{self.root}/manifests")
        path = f"{self.root}/manifests/m{int(known[-1][1:]) + 1 if known else 1:08d}"
        text.coalesce(1).write.mode("overwrite").text(path)
        tables.mark(self.spark, path)

    def drop_unused(self, keep: int = 2) -> None:
        """Delete the manifests but the newest ``keep``, and the buckets that none of these names."""
        found = self._manifests()
        if not found:
            return
        for path in found[:-keep]:
            tables.remove(self.spark, path)
        kept = [self._manifest(path)["folders"] for path in found[-keep:]]
        needed = {(change, int(b)) for folders in kept for b, change in folders.items()}
        newest = max(change for change, _ in needed)
        for part in tables.folders(self.spark, f"{self.root}/data"):
            for folder in tables.folders(self.spark, self._data(part)):
                change, path = int(folder.split("=")[1]), f"{self._data(part)}/{folder}"
                buckets = [int(name.split("=")[1]) for name in tables.folders(self.spark, path)]
                if change > newest:
                    continue
                for b in buckets:
                    if (change, b) not in needed:
                        tables.remove(self.spark, f"{path}/{BUCKET}={b}")
