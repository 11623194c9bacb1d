"""Sharding by a two-pass external shuffle.

First pass: a seeded hash of id and content scatters the records over buckets of about ``bucket_bytes``,
so that one fits into a task's memory, and each bucket goes to the task of its number. Second pass: each bucket is put
in a fixed order and permuted by Spark's ``shuffle`` function (a Fisher-Yates shuffle, seeded), then written. Buckets one
after another are one random order of all records; its equal cuts are the shards, whose row counts differ by one at most.

The records travel once. What is permuted are the numbers 0 to n-1 of a bucket, in a table of one row a bucket that
is partitioned as the records are: the merge join of the two moves nothing and nothing of it passes through the driver.
Partition numbers and row order are fixed before the permutation is drawn: a lost task draws the same one again.

Rows equal in id and text that make up more than an eighth of a bucket are dealt over several buckets, by a hash of where they
stand in the input; all others go by content alone, however the input is partitioned. So that a lost task deals them as before, an
input with such groups must read the same again, as files do; pass ``stored`` rows where it is computed. The table of these
groups has at most eight rows for each bucket; Spark broadcasts it if its size is below the session's threshold.
With ``bucket_bytes`` of 64 MB, 100 TB make 1.6 million buckets; larger executors take larger buckets.

Defined results: a null text counts 8 bytes; null ids take part; equal rows stay apart as so many records; a
text longer than a bucket is a bucket's one long row; an empty table writes no file and reads back empty; input columns
named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import stored, without

OUTPUT = ("size", "shard", "slot", "bucket")
_OWN = ("_place", "_order", "_rows", "_turns", "_before", "_at", "_bytes", "_pieces")


def record_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def external_shuffle(
    docs: DataFrame,
    path: str,
    *,
    shards: int = 24,
    seed: int = 20_011,
    bucket_bytes: int = 64 << 20,
    least_buckets: int = 16,
) -> DataFrame:
    """Write ``docs`` to ``path``, a folder per shard, and read them back with shard and slot."""
    shuffled = arranged(docs, shards=shards, seed=seed, bucket_bytes=bucket_bytes, least_buckets=least_buckets)
    shuffled.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(shuffled.schema).parquet(path)


def arranged(docs: DataFrame, *, shards: int, seed: int, bucket_bytes: int, least_buckets: int) -> DataFrame:
    """``docs`` with size, slot, bucket and shard; the partition numbered as a bucket holds it in its final order.

    ``bucket_bytes`` is what a task of the second pass sorts at a time; the number of buckets follows the data,
    ``least_buckets`` give a small table its parallel tasks.
    """
    docs = without(docs, [*OUTPUT, *_OWN])
    sized = docs.withColumn("size", record_bytes(F.col("text")))
    content = F.xxhash64("doc_id", F.crc32(F.col("text").cast("binary")), F.lit(seed))
    ordered = sized.withColumn("_at", F.monotonically_increasing_id()).withColumn("_order", content)
    groups = ordered.groupBy("_order").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    groups = stored(groups, "shuffle_groups")
    total, count = groups.agg(F.coalesce(F.sum("_bytes"), F.lit(0)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    buckets = max(least_buckets, -(-total // bucket_bytes))

    piece = max(1, min(bucket_bytes, -(-total // buckets)) // 8)
    large = groups.filter((F.col("_rows") > 1) & (F.col("_bytes") > piece))
    large = stored(large.select("_order", F.ceil(F.col("_bytes") / piece).alias("_pieces")), "shuffle_large")
    turn = F.when(F.col("_pieces").isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64("_at"), "_pieces"))
    bucket = F.pmod(F.xxhash64("_order", turn, F.lit(seed + 1)), F.lit(buckets)).cast("int")
    keyed = ordered.join(large, "_order", "left").withColumn("bucket", bucket).drop("_at", "_pieces")

    rows = keyed.groupBy("bucket").agg(F.count("*").alias("_rows"))
    ends = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    turns = (
        rows.withColumn("_before", F.coalesce(F.sum("_rows").over(ends), F.lit(0)))
        .repartitionById(buckets, "bucket")
        .select("bucket", "_before", F.shuffle(F.sequence(F.lit(0), F.col("_rows") - 1), seed).alias("_turns"))
    )
    inside = Window.partitionBy("bucket").orderBy("_order", "doc_id", "size")
    place = F.col("_before") + F.get("_turns", F.col("_place") - 1)
    # Whole-number cuts: shard s begins at the first place p with p * shards // count = s.
    shard = F.expr(f"CAST((_place * {shards}L) DIV {max(1, count)}L AS INT)")
    begins = F.expr(f"(shard * {count}L + {shards - 1}) DIV {shards}L")
    return (
        keyed.repartitionById(buckets, "bucket")
        .withColumn("_place", F.row_number().over(inside))
        .join(turns.hint("merge"), "bucket")
        .withColumn("_place", place)
        .withColumn("shard", shard)
        .withColumn("slot", F.col("_place") - begins)
        .sortWithinPartitions("bucket", "_place")
        .select(*[F.col(f"`{c}`") for c in docs.columns], "size", "slot", "bucket", "shard")
    )
