"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue. Its documents are shuffled by a seeded hash; a document's virtual finish time
is the number of words its source has sent by then, divided by the source's target. All documents of
all sources are put in the order of that time and the mix ends where the total budget is used up, so each
source stops within about one document of its target. A source whose target exceeds its size
sends its documents again, in the same order, after the first pass.

Sums along a source are taken in two steps: the hash range is cut into buckets of about
``rows_per_bucket`` rows, bucket totals are added up per source, and only rows of a bucket
are sorted together. The end of the mix is found likewise: totals per range of finish times, then a sort
of the one range in which the budget runs out. A source with a third of all rows is so many more buckets.

Defined results: a null or empty text has size 0 and is never taken; a null source is a source of its
own, ranked last; documents with equal finish times at the very end are all left out; rows that are equal
in id and text stand next to each other and are taken one by one; an empty table gives an empty table;
input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import stored, without, word_count

HASH_RANGE = 1 << 52
OUTPUT = ("size", "source_size", "target", "copies")
_OWN = ("_mix_key", "_mix_crc", "_mix_rank", "_mix_bucket", "_mix_buckets", "_mix_before", "_mix_sent", "_mix_weight")


def _key(seed: str) -> Column:
    """52 bits of a hash that SQL engines share."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(F.concat(name, F.lit(f"|{seed}"))), 1, 13), 16, 10).cast("long")


def targets(totals: DataFrame, share: float, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """Targets of the sources (source, source_size, rows): the budget by weight, cut at ``repeats`` sizes.

    Sources are ordered by the level at which their limit is reached; the first whose share of what the
    sources before it leave fits below its limit gives the level of all that follow.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = totals.withColumn("_mix_rank", F.row_number().over(by_name) - 1).withColumn(
        "_mix_weight", F.get(cycle, F.col("_mix_rank") % len(weights))
    )
    limit = F.col("source_size") * repeats
    every = Window.partitionBy()
    by_level = Window.orderBy(limit / F.col("_mix_weight"), "_mix_rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) * share - F.coalesce(F.sum(limit).over(before), F.lit(0))) / F.sum(
        "_mix_weight"
    ).over(after)
    levels = ranked.withColumn("_level", level).withColumn("_place", F.row_number().over(by_level))
    fits = F.col("_level") * F.col("_mix_weight") <= limit
    first = F.min(F.when(fits, F.struct("_place", "_level"))).over(every)
    target = F.when(F.col("_place") >= first["_place"], first["_level"] * F.col("_mix_weight")).otherwise(limit)
    return levels.withColumn("target", target.cast("double")).select(
        "source", "source_size", "rows", "target", "_mix_rank"
    )


def mix(
    docs: DataFrame,
    *,
    share: float = 1.5,
    weights: tuple[int, ...] = (5, 2, 1),
    repeats: int = 2,
    seed: str = "mix-1",
    rows_per_bucket: int = 4000,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``, the times a document is taken."""
    spark = docs.sparkSession
    docs = without(docs, [*OUTPUT, *_OWN])
    sized = docs.withColumn("size", word_count(F.col("text"))).withColumn("_mix_key", _key(seed))
    slim = stored(sized.select("source", "size", "_mix_key"), "mix-sizes")

    totals = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    goals = stored(
        targets(totals, share, weights, repeats).withColumn(
            "_mix_buckets", F.ceil(F.col("rows") / rows_per_bucket).cast("long")
        ),
        "mix-targets",
    )

    def with_bucket(df: DataFrame) -> DataFrame:
        other = goals.drop("rows").withColumnRenamed("source", "_mix_source")
        joined = df.join(other, F.col("source").eqNullSafe(F.col("_mix_source"))).drop("_mix_source")
        return joined.withColumn(
            "_mix_bucket",
            F.floor(F.col("_mix_key").cast("double") / HASH_RANGE * F.col("_mix_buckets")).cast("long"),
        )

    sums = with_bucket(slim).groupBy("_mix_rank", "_mix_bucket").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("_mix_rank").orderBy("_mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        sums.select(
            "_mix_rank", "_mix_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_mix_before")
        ),
        "mix-offsets",
    )

    def with_sent(df: DataFrame, order: list[str]) -> DataFrame:
        """Words that a row's source has sent when the row ends its first turn."""
        inside = Window.partitionBy("_mix_rank", "_mix_bucket").orderBy(*order)
        running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return (
            with_bucket(df)
            .join(offsets, ["_mix_rank", "_mix_bucket"])
            .withColumn("_mix_sent", running + F.col("_mix_before"))
        )

    def finish(turn: int) -> Column:
        return F.when(
            F.col("target") > 0, (F.col("_mix_sent") + turn * F.col("source_size")) / F.col("target")
        )

    # The budget, and the finish time at which it is used up.
    total, rows = slim.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    budget, ranges = total * share, max(1, -(-rows // rows_per_bucket))
    turns = F.explode(F.array(*[finish(turn) for turn in range(repeats)])).alias("v")
    times = stored(with_sent(slim, ["_mix_key", "size"]).select("size", turns).filter("size > 0"), "mix-times")
    span = F.floor(F.col("v") * ranges).cast("long")
    by_range = times.groupBy(span.alias("range")).agg(F.sum("size").alias("words"))
    so_far = F.sum("words").over(Window.orderBy("range"))
    over = by_range.select("range", "words", so_far.alias("end")).filter(F.col("end") > budget)
    first = over.orderBy("range").first()
    cut = None
    if first is not None:
        start = first["end"] - first["words"]
        within = F.sum("size").over(Window.orderBy("v"))  # rows of equal time count together
        cut = (
            times.filter(span == first["range"])
            .select("v", (within + F.lit(start)).alias("end"))
            .filter(F.col("end") > budget)
            .agg(F.min("v"))
            .first()[0]
        )
    taken = [
        (F.col("size") > 0) & (finish(turn) < F.lit(cut) if cut is not None else finish(turn).isNotNull())
        for turn in range(repeats)
    ]
    copies = sum((F.when(t, 1).otherwise(0) for t in taken), F.lit(0)).cast("int")
    mixed = with_sent(
        sized.withColumn("_mix_crc", F.crc32(F.col("text").cast("binary"))),
        ["_mix_key", "size", "doc_id", "_mix_crc"],
    ).withColumn("copies", copies)
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns], *OUTPUT)


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*columns)
