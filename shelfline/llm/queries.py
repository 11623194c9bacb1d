"""The registered query of each operator: its production parameters over the whole table, digest columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from shelfline.llm import (
    language,
    licenses,
    mixing,
    near_dedup,
    packing,
    prefix_trie,
    ranking,
    rules,
    secrets,
    sharding,
    substrings,
    toxicity,
    vectors,
)
from shelfline.llm.common import reach_workers, table
from shelfline.session import shared_dir


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "copies")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.ledger(table(spark, sf_dir, "documents"))
    base = ("doc_id", *rules.MEASURES[:5])
    return rows.select(
        *base, (~rules.passes("base")).alias("base_failed"), rules.passes(rules.CURRENT).alias("kept"), "failed"
    )


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identified(docs, language.fit(docs))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = sharding.external_shuffle(table(spark, sf_dir, "documents"), shared_dir(spark, "shards"))
    return written.select(
        "doc_id",
        "size",
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def _span_text(spans: Column) -> Column:
    kinds = F.array(*[F.lit(rule.kind) for rule in secrets.RULES])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ","
    )


def _only(rank: int) -> Callable[[Column], Column]:
    return lambda found: F.when(found == rank, found)


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.Ledger(spark, shared_dir(spark, "secrets")).scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE_RULES))
    ranks = F.transform("spans", lambda s: s["rank"])
    counts = [
        F.size(F.array_compact(F.transform(ranks, _only(rank)))).cast("long").alias(f"n_{rule.kind}")
        for rank, rule in enumerate(secrets.BASE_RULES)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_span_text(base).cast("binary"), 256).alias("base_sha256"),
        _span_text(F.col("spans")).alias("spans"),
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(table(spark, sf_dir, "documents"))


Query = Callable[[SparkSession, str], DataFrame]


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reach_workers(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _ready(query)
    for query in (
        op1_license_scans,
        op2_minhash_dedup,
        op3_toxicity,
        op4_mixing,
        op5_quality_rules,
        op6_embedding_dedup,
        op7_language_id,
        op8_sharding,
        op9_best_fit_packing,
        op10_secret_scans,
        op11_ranked_search,
        op12_prefix_trie,
        op13_substring_dedup,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run
