"""From raw documents to packed sequences: toxicity, near-dedup, secrets, mixing, packing.

Each stage takes all that its predecessor kept, as a table, and returns the columns of documents; the last one returns
the pieces of packed sequences. SQL cannot express the trained and the approximate stages: ``ORACLE_SQL`` is
None, ``tests/llm/test_pipeline.py`` compares every stage with a brute-force version of its decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import mixing, near_dedup, packing, secrets, toxicity
from shelfline.llm.common import reach_workers, stored, table
from shelfline.session import shared_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the calibrated trees call toxic go."""
    reach_workers(spark)
    return toxicity.reject(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    reach_workers(spark)
    return near_dedup.representatives(docs).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; found secrets give way to a mark."""
    reach_workers(spark)
    clean = secrets.redact(docs, secrets.Ledger(spark, shared_dir(spark, "secrets")))
    length = F.char_length("text").cast("long")
    return clean.withColumn("n_chars", F.coalesce(length, F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    reach_workers(spark)
    return mixing.repeated(mixing.mix(docs), list(COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 2048 tokens."""
    reach_workers(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_copies),
    ("secret_scans", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
