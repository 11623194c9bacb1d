"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

A text in lower case, its signs and digits as blanks, becomes hashed counts of n-grams of one to three characters in
``BUCKETS`` buckets. Document frequencies are counted over all rows that may be learned from. The regression is
trained by follow-the-regularised-leader with an elastic net (most weights stay exactly 0) on at most
``MAX_TRAINING_ROWS`` rows, the same number of each language, drawn by a hash; a fifth of them is kept back to
fit the temperature that turns scores into probabilities.

Rows whose ``crc32(doc_id) mod 3`` is 1 are held out, and rows without a language are not learned from.

Defined results: a null text or one without a letter is ``und`` with score 0, and so is every row where there is nothing
to learn from; a null id is not held out and not learned from; equal rows get equal results; other columns are
left behind; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import stored

BITS = 15
BUCKETS = 1 << BITS
MAX_TRAINING_ROWS = 4000
UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1
_LETTER = re.compile(r"[^\W\d_]")
# Characters below 0x250 that are no letters count as blanks.
_KEPT = np.array([c if chr(c).isalpha() else 32 for c in range(0x250)], dtype=np.uint32)
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's n-grams and how often each occurs."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    chars = np.where(chars < len(_KEPT), _KEPT[np.minimum(chars, len(_KEPT) - 1)], chars)
    one = chars * _FACTORS[0]
    parts = [one]
    if len(chars) > 1:
        two = (one[:-1] ^ np.uint32(0x5BD1E995)) * _FACTORS[1] + one[1:]
        parts.append(two)
        if len(chars) > 2:
            parts.append((two[:-1] ^ np.uint32(0x27D4EB2F)) * _FACTORS[2] + one[2:])
    mixed = np.concatenate(parts)
    mixed ^= mixed >> np.uint32(15)
    mixed = (mixed * _FACTORS[1]) >> np.uint32(32 - BITS)
    counts = np.bincount(mixed, minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def has_letter(text: str) -> bool:
    """Whether a character of a letter category stands in the text; the pattern also finds signs such as ½."""
    return any(found.group().isalpha() for found in _LETTER.finditer(text))


def weighted(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and TF-IDF values of length 1."""
    found, counts = ngrams(text)
    values = np.log1p(counts) * idf[found]
    return found, values / (math.sqrt(float(values @ values)) or 1.0)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        found, values = weighted(text, self.idf)
        shares = softmax(values @ self.weights[found] / self.temperature)
        best = int(np.argmax(shares))
        return self.languages[best], float(shares[best])


def softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max())
    return powers / powers.sum()


def train(
    rows: list[tuple[int, np.ndarray, np.ndarray]],
    kinds: int,
    *,
    passes: int = 4,
    rate: float = 3.0,
    smooth: float = 1.0,
    lasso: float = 0.02,
    ridge: float = 0.02,
) -> np.ndarray:
    """Weights by follow-the-regularised-leader; ``rows`` hold the kind, the buckets and the values."""
    z, n = np.zeros((BUCKETS, kinds)), np.zeros((BUCKETS, kinds))

    def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        step = (smooth + np.sqrt(n)) / rate + ridge
        return np.where(np.abs(z) <= lasso, 0.0, -(z - np.sign(z) * lasso) / step)

    order = np.random.default_rng(7)
    for _ in range(passes):
        for row in order.permutation(len(rows)):
            kind, found, values = rows[row]
            old = n[found]
            weights = weights_of(z[found], old)
            error = softmax(values @ weights)
            error[kind] -= 1.0
            slope = values[:, None] * error
            new = old + slope * slope
            z[found] += slope - (np.sqrt(new) - np.sqrt(old)) / rate * weights
            n[found] = new
    return weights_of(z, n)


def fitted_temperature(rows: list[tuple[int, np.ndarray, np.ndarray]], weights: np.ndarray) -> float:
    """The temperature under which ``rows`` are likeliest, by golden section over its logarithm."""
    if not rows:
        return 1.0
    scores = np.array([values @ weights[found] for _, found, values in rows])
    kinds = np.array([kind for kind, _, _ in rows])

    def loss(log_t: float) -> float:
        at = scores / math.exp(log_t)
        top = at.max(axis=1)
        return float(np.mean(top + np.log(np.exp(at - top[:, None]).sum(axis=1)) - at[np.arange(len(kinds)), kinds]))

    low, high, golden = math.log(0.05), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        if loss(a) < loss(b):
            high = b
        else:
            low = a
    return math.exp((low + high) / 2)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _document_frequencies(known: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts of ``known`` each bucket occurs, and how many texts there are."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                total[ngrams(text)[0]] += 1
                rows += 1
        found = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": np.append(found, -1), "n": np.append(total[found], rows)})

    sums = known.select("text").mapInPandas(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    frequencies, rows = np.zeros(BUCKETS), 0
    for bucket, n in sums.collect():  # at most one row per bucket
        if bucket < 0:
            rows = n
        else:
            frequencies[bucket] = n
    return frequencies, rows


def fit(docs: DataFrame, *, max_rows: int = MAX_TRAINING_ROWS) -> Model:
    known = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
        .filter((fold(F.col("doc_id")) != HELD_OUT) & F.col("lang").isNotNull())
        .filter(F.col("text").rlike(r"\p{L}"))
    )
    sizes = {
        row["lang"]: row["n"]
        for row in docs.filter((fold(F.col("doc_id")) != HELD_OUT) & F.col("lang").isNotNull())
        .groupBy(F.col("lang").cast("string").alias("lang"))
        .agg(F.count("*").alias("n"))
        .collect()  # a row for each language
    }
    languages = sorted(sizes)
    nothing = Model([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), 1.0)
    if not languages:
        return nothing
    frequencies, rows = _document_frequencies(known)
    idf = np.log((1 + rows) / (1 + frequencies)) + 1

    each = max(1, max_rows // len(languages))
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, each / sizes[lang]))])
    drawn = F.pmod(F.xxhash64("doc_id", "text", F.lit(17)), F.lit(1_000_003)) < F.try_element_at(share, F.col("lang")) * 1_000_003
    place = {lang: number for number, lang in enumerate(languages)}

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [weighted(text, idf) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "kind": [place[lang] for lang in batch["lang"]],
                    "buckets": [f[0].astype("<i4").tobytes() for f in found],
                    "values": [f[1].astype("<f8").tobytes() for f in found],
                }
            )

    sample = stored(
        known.filter(drawn).mapInPandas(described, "doc_id long, kind int, buckets binary, values binary"), "languages"
    )
    place_of_row = F.xxhash64("doc_id", "buckets", "values", F.lit(19))
    if max_rows > 0 and sample.count() > 3 * max_rows + 100:  # rows that repeat share their hash
        sample = sample.orderBy(place_of_row, "kind").limit(max_rows)
    learned, checked = [], []
    for doc_id, kind, buckets, values in sample.orderBy(place_of_row, "kind").collect():
        row = (kind, np.frombuffer(buckets, "<i4"), np.frombuffer(values, "<f8"))
        (checked if len(learned) > 4 * len(checked) + 3 else learned).append(row)
    if not learned:
        return nothing
    weights = train(learned, len(languages))
    return Model(languages, idf, weights, fitted_temperature(checked, weights))


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """A row per document: ``held_out``, ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers for each language

    def predicted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shared.value.predict(text) for text in batch["text"]]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"].array, "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInPandas(predicted, "doc_id long, lang_pred string, score double").select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
