"""Current state from a change feed.

Each micro-batch is reduced to the newest change per key and stored under its batch number, so a
batch costs in proportion to itself and not to the whole state, and replaying it changes nothing. ``fold`` merges finished
batches into the state's buckets: only buckets that hold a changed key are read and written. Buckets and
later batches together always hold the newest change of every key. Deletes stay in the buckets as tombstones: a
late, older update cannot bring a deleted key back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfline.plans.silver import CHANGE_KEYS, newest_change, without_tombstones
from shelfline.sources import tables
from shelfline.sources.batches import BatchTable
from shelfline.sources.buckets import BucketState

PART = "newest"


class ChangeTable:
    """The stored state of one change feed below ``root``. One caller at a time folds: the owner of the table."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark = spark
        self.batches = BatchTable(spark, f"{root}/batches")
        self.state = BucketState(spark, f"{root}/state", CHANGE_KEYS, buckets)

    def write_batch(self, changes: DataFrame, batch_id: int) -> None:
        """Store one micro-batch (the writer of a ``foreachBatch`` stream)."""
        self.batches.write(newest_change(changes), batch_id)

    def writer(self, fold_every: int) -> Callable[[DataFrame, int], None]:
        """As :meth:`write_batch`, and folds now and then, for a stream that never ends and owns the table."""

        def write(changes: DataFrame, batch_id: int) -> None:
            self.write_batch(changes, batch_id)
            if (batch_id + 1) % fold_every == 0:
                self.fold()

        return write

    def newest(self) -> DataFrame:
        """Newest change per key, tombstones included."""
        upto, folded = self.state.upto(), self.state.read(PART)
        later = [number for number in self.batches.numbers() if number > upto]
        if folded is None and not later:
            raise FileNotFoundError(f"no changes stored under {self.state.root}")
        if not later:
            return folded
        rows = self.batches.read(after=upto)
        return newest_change(rows if folded is None else folded.unionByName(rows))

    def fold(self) -> list[int]:
        """Merge the batches since the last fold into the buckets they touch, which are returned."""
        upto = self.state.upto()
        later = [number for number in self.batches.numbers() if number > upto]
        if not later:
            return []
        rows = self.batches.read(after=upto, upto=later[-1])
        touched = self.state.touched(rows)
        old = self.state.read(PART, touched)
        change = self.state.start()
        self.state.write(change, PART, newest_change(rows if old is None else old.unionByName(rows)))
        self.state.commit(change, touched, later[-1])
        return touched

    def current(self) -> DataFrame:
        """Current rows, without deleted keys and without change columns."""
        return without_tombstones(self.newest())

    def drop_folded(self, keep: int = 2) -> None:
        """Delete buckets that the newest ``keep`` states no longer need, and the batches that the oldest of them holds."""
        self.state.drop_unused(keep)
        held = self.state.oldest_upto()
        for number in self.batches.numbers():
            if number <= held:
                tables.remove(self.spark, self.batches.folder(number))
