"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the one that is greatest by ``order``.

    Spark cuts the ranking to its first place before the shuffle as well as after it, so every map
    task sends on at most one row per key and a key that holds a large share of the rows costs no
    more than any other. Rows that are equal in ``order`` are told apart by a hash of all their
    columns, which keeps the result repeatable.
    """
    newest_first = [column.desc() for column in (*order, F.xxhash64(*rows.columns))]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return rows.withColumn("_place", place).filter("_place = 1").drop("_place")
