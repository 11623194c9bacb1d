"""The pipeline's stages against what their operators say about the same rows."""

import collections

import corpus_pipeline
from shelfline.llm import near_dedup, toxicity
from shelfline.llm.common import stored, table


def test_stages_on_the_given_tables(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], sf_dir), name))
    raw, clean, single, safe, mixed, packed = tables
    assert all(t.columns == docs.columns for t in tables[:5])

    toxic = toxicity.scored(raw, table(spark, sf_dir, "labels")).filter("predicted = 1").select("doc_id")
    assert clean.count() == raw.count() - toxic.count() and clean.join(toxic, "doc_id", "left_semi").count() == 0

    kept = {r.doc_id for r in near_dedup.near_duplicates(clean).filter("kept OR n_shingles = 0").collect()}
    assert {r.doc_id for r in single.select("doc_id").collect()} == kept

    assert safe.count() == single.count()
    assert safe.filter("text RLIKE '[0-9a-f]{24,}'").count() == 0

    copies = collections.Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert set(copies) <= kept and max(copies.values()) <= 2
    pieces = packed.collect()
    assert collections.Counter(r.doc_id for r in pieces if r.piece == 0) == copies
    fill = collections.Counter()
    for r in pieces:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048


def test_pipeline_of_an_empty_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
