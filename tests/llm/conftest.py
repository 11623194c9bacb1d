import pytest

from shelfline.llm.common import reach_workers

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def workers(spark):
    reach_workers(spark)


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text) or (doc_id, text, lang, source) rows, with columns that clash."""

    def make(rows, **extra):
        full = [(row[0], row[1], *(row[2:] or (None, None)), len(row[1] or "")) for row in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        for name in ("size", "shard", "slot", "target", "score", "kept", "code", "uid", "blob", "_crc", "copies"):
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make
