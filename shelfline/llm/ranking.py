"""Ranked lexical search by hashed max-sketches.

A document's impacts, one for each distinct term, are folded into a sketch of ``WIDTH`` coordinates: a
term's hash names its coordinate, and each coordinate holds the greatest impact that fell on it. For a batch of queries the
sum of a query's weights times the coordinates of its terms is an upper bound of the score, as a coordinate is never
below the impact of any term in it. Documents are scored exactly in descending order of their bounds, until the bound
falls below the lowest score that still ranks.

The corpus is read twice for a block of queries: once for its size and the document frequencies of the
queries' terms, once for sketches, bounds and scores, which happen where the text is read. Every task keeps the best
documents of each query only, so what it sends does not grow with its rows; these are ranked in two steps, so that
no query meets in one task. A block holds about ``BLOCK`` queries; it is what reaches the driver and the tasks.

Terms are the runs of characters other than ASCII signs and separators, A-Z lower-cased. Weights and scores
are whole numbers, see :func:`weight` and :func:`impact`.

Defined results: a null or empty text, or one without a term, is no document of the statistics and is never
found; a query without terms finds nothing; repeated rows are documents of their own; rows that repeat an item, id and
text, are one item; equal scores are ranked by doc_id, a null one last; only documents with a score above 0 are
returned; an empty table on either side gives an empty result; columns other than id and text are left behind.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Places, and the constants of the score.
TOP, SCALE, STEP, SLOPE, SHARE = 20, 1_000_000_000, 1000, 12, 25
# Coordinates of a sketch, queries of a block, documents whose bounds are sorted together.
WIDTH, BLOCK, BATCH = 4096, 512, 1024
_GROUPS = 64
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Bytes of a term above 127 belong to characters beyond ASCII, which all belong to terms."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def length_part(n: int, documents: int, length: int) -> int:
    return 100 - SHARE + (SHARE * n * documents) // length


def impact(tf: int, m: int) -> int:
    return (SCALE * tf) // (STEP * tf + SLOPE * m)


@dataclass(frozen=True)
class Queries:
    """A block of queries with their terms, and what the corpus says about these."""

    terms: tuple[Counter, ...]
    documents: int
    length: int
    frequency: dict[bytes, int]

    def weighed(self) -> list[list[tuple[bytes, int]]]:
        """Each query's terms with their weights, repeats included."""
        known = {t: weight(self.documents, f) for t, f in self.frequency.items()}
        return [[(t, known[t] * times) for t, times in query.items() if t in known] for query in self.terms]


def _coordinates(terms: list[bytes], width: int) -> np.ndarray:
    return np.array([zlib.crc32(term) for term in terms], dtype=np.int64) % width


class Sketcher:
    """Max-sketches of documents and their bounds for a block of queries."""

    def __init__(self, weighed: list[list[tuple[bytes, int]]], width: int):
        self.width = width
        asked = sorted({int(c) for query in weighed for c in _coordinates([t for t, _ in query], width)})
        self.row = np.full(width, -1, dtype=np.int64)
        self.row[asked] = np.arange(len(asked))
        self.weights = np.zeros((len(asked), len(weighed)))
        for q, query in enumerate(weighed):
            for (_, w), c in zip(query, _coordinates([t for t, _ in query], width)):
                self.weights[self.row[c], q] += w

    def sketch(self, counts: Counter, m: int) -> tuple[np.ndarray, np.ndarray]:
        """The coordinates that are not zero, and their maxima."""
        tf = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
        impacts = (SCALE * tf) // (STEP * tf + SLOPE * m)
        at = _coordinates(list(counts), self.width)
        order = np.lexsort((impacts, at))
        at, impacts = at[order], impacts[order]
        last = np.r_[at[1:] != at[:-1], True]
        return at[last], impacts[last]

    def bounds(self, counts: Counter, m: int) -> np.ndarray:
        at, most = self.sketch(counts, m)
        rows = self.row[at]
        hit = rows >= 0
        # A little more than the sum, so that rounding can never put a bound below a score.
        return (most[hit].astype(float) @ self.weights[rows[hit]]) * (1 + 1e-9)


def _best_of_task(queries: Queries, top: int, width: int, batch_rows: int):
    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weighed = queries.weighed()
        sketcher = Sketcher(weighed, width)
        found: list[list[tuple[int, int, int]]] = [[] for _ in weighed]  # heaps of (score, has an id, -id)
        lowest = np.zeros(len(weighed))

        def rescored(ids: list, counted: list[tuple[Counter, int]], bounds: np.ndarray) -> None:
            reach = (bounds > 0) & (bounds >= lowest)
            for q in np.flatnonzero(reach.any(axis=0)).tolist():
                heap = found[q]
                rows = np.flatnonzero(reach[:, q])
                for d in rows[np.argsort(-bounds[rows, q], kind="stable")].tolist():
                    if len(heap) == top and bounds[d, q] < heap[0][0]:
                        break
                    counts, m = counted[d]
                    score = sum(w * impact(counts[t], m) for t, w in weighed[q] if t in counts)
                    if score > 0:
                        entry = (score, 1, -int(ids[d])) if not pd.isna(ids[d]) else (score, 0, 0)
                        if len(heap) < top:
                            heapq.heappush(heap, entry)
                        else:
                            heapq.heappushpop(heap, entry)
                if len(heap) == top:
                    lowest[q] = heap[0][0]

        for batch in batches:
            for start in range(0, len(batch), batch_rows):
                part = batch.iloc[start : start + batch_rows]
                ids, counted, bounds = [], [], []
                for doc_id, text in zip(part["doc_id"], part["text"]):
                    terms = terms_of(text)
                    if terms:
                        m = length_part(len(terms), queries.documents, queries.length)
                        counts = Counter(terms)
                        ids.append(doc_id)
                        counted.append((counts, m))
                        bounds.append(sketcher.bounds(counts, m))
                if ids:
                    rescored(ids, counted, np.array(bounds))
        rows = [(q, -i if known else None, s) for q, heap in enumerate(found) for s, known, i in heap]
        out = pd.DataFrame(rows, columns=["query", "doc_id", "score"])
        yield out.astype({"query": "int64", "doc_id": "Int64", "score": "int64"})

    return best


def _statistics(docs: DataFrame, vocabulary: frozenset[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """Documents, their terms, and in how many documents each term of the vocabulary stands."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequency: Counter = Counter()
        documents = length = 0
        for batch in batches:
            for text in batch["text"]:
                terms = terms_of(text)
                documents += bool(terms)
                length += len(terms)
                frequency.update(vocabulary.intersection(terms))
        rows = [(None, documents), (b"", length), *frequency.items()]
        yield pd.DataFrame(rows, columns=["term", "n"])

    sums = docs.select("text").mapInPandas(counted, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    # A row for each term of the block's queries.
    found = {None if r.term is None else bytes(r.term): r.n for r in sums.collect()}
    return found.pop(None, 0), found.pop(b"", 0), found


def _ranked(best: DataFrame, top: int) -> DataFrame:
    order = F.desc("score"), F.asc_nulls_last("doc_id")
    part = Window.partitionBy("query", F.pmod(F.xxhash64("doc_id", "score"), F.lit(_GROUPS))).orderBy(*order)
    first = best.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top).drop("rank")
    place = F.row_number().over(Window.partitionBy("query").orderBy(*order)).cast("int")
    return first.withColumn("rank", place).filter(F.col("rank") <= top)


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    top: int = TOP,
    width: int = WIDTH,
    block: int = BLOCK,
    batch_rows: int = BATCH,
) -> DataFrame:
    """The ``top`` documents (doc_id, text) for each of ``items`` (item_id, text): item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct()
    blocks = max(1, -(-items.count() // block))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    schema = "item_id long, rank int, doc_id long, score long"
    results = [spark.createDataFrame([], schema)]
    for at in range(blocks):
        asked = [(r.item_id, Counter(terms_of(r.text))) for r in items.filter(number == at).collect()]
        asked = [(item, terms) for item, terms in asked if terms]
        documents, length, frequency = _statistics(docs, frozenset().union(*(t for _, t in asked)))
        if not frequency:
            continue
        queries = Queries(tuple(t for _, t in asked), documents, length, frequency)
        best = docs.mapInPandas(_best_of_task(queries, top, width, batch_rows), "query long, doc_id long, score long")
        named = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(asked)], "query long, item_id long")
        results.append(_ranked(best, top).join(F.broadcast(named), "query").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionByName, results[1:] or results)
