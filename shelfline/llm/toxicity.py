"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon is a fixed list of insults and what labelled rows add to it: words and beginnings of words that stand in
many toxic texts and in hardly any other, at most ``LEARNED_TERMS``, learned from at most ``LEXICON_ROWS`` rows of
each kind, of which near copies count once. A text becomes a few rates: how dense words of the lexicon stand, how near the second person they stand, how many
of them are written with other signs in place of letters, how much of the text is capitals or
punctuation. Spark's gradient-boosted trees learn from labelled rows, at most ``MAX_TRAINING_ROWS``
of them, chosen by a hash. The margin of the trees is turned into a probability by an isotonic regression
over labelled rows that the trees have not seen.

Rows whose ``crc32(doc_id) mod 5`` is 0 are held out: no label of theirs is read. Remainder 1 calibrates, the rest trains.

Defined results: a null or empty text has all features 0 and gets a score like any other; a null id is not held
out and never labelled; of labels that contradict each other for one id the larger counts; a table without labels of
both kinds scores every row with the share of toxic labels, 0 where there are none; other columns of
``docs`` are kept by ``reject`` and not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import stored, without

MAX_TRAINING_ROWS = 40_000
FOLDS = 5
NEAR = 6  # words
LEXICON_ROWS, LEARNED_TERMS = 6_000, 200
SHORTEST, LONGEST = 3, 6  # letters of a word's beginning

# Insults, and pronouns of the second person in the languages of the corpus.
LEXICON = frozenset(
    "stupid idiot idiotic moron moronic scum trash loser clown pathetic worthless disgusting dumb dumbass imbecile "
    "jerk bastard bitch asshole ass fuck fucking fucker shit shitty crap cunt dick prick slut whore retard retarded "
    "garbage filth filthy vermin parasite pig coward freak ugly fool foolish liar creep psycho lunatic degenerate "
    "subhuman hate despise nasty vile trashy dimwit halfwit blockhead scumbag dirtbag sleazy "
    "dumm dummkopf idioten abschaum schwachkopf arschloch scheisse verlierer trottel widerlich wertlos "
    "connard salaud merde imbécile crétin débile ordure raclure minable abruti "
    "idiota imbécil estúpido estúpida basura escoria perdedor payaso asqueroso inútil mierda cabrón".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine euch tu te toi ton ta tes vous votre vos "
    "tú ti tuyo tus usted ustedes vosotros".split()
)
EDGE = ".,;:!?\"'()[]{}<>«»“”‘’…-_*#$%&|~`/\\"
LEET = str.maketrans("013457@$!|+", "oieastasiit")
_MIXED = re.compile(r"[^\W\d_][0-9@$!*._-]+[^\W\d_]|[0-9@$][^\W\d_]{2}")
_CAPITAL = re.compile("[A-ZÀ-ÖØ-Þ]")
_RUNS = re.compile(r"(.)\1{2,}")

FEATURES = (
    "log_words",
    "lexicon_hits",
    "lexicon_density",
    "learned_hits",
    "lexicon_kinds",
    "lexicon_spread",
    "near_second_person",
    "second_person_rate",
    "disguised_hits",
    "disguised_rate",
    "capital_rate",
    "shouted_words",
    "exclamations",
    "punctuation_rate",
    "digit_rate",
    "long_runs",
    "repeated_words",
)


def _plain(word: str) -> str:
    """A disguised word with its letters back: digits and signs for letters, dots between them, drawn-out letters."""
    letters = re.sub(r"[^\w]", "", word.translate(LEET)).replace("_", "")
    return _RUNS.sub(r"\1", letters)


class Lexicon:
    """Fixed and learned words, and learned beginnings of words."""

    def __init__(self, words: frozenset[str] = frozenset(), beginnings: frozenset[str] = frozenset()):
        self.words, self.beginnings = words, beginnings
        self.all_words = LEXICON | words
        self.heads = frozenset(term[:SHORTEST] for term in self.all_words | beginnings)

    def learned(self, word: str) -> bool:
        return word in self.words or any(
            word[:length] in self.beginnings for length in range(SHORTEST, min(LONGEST, len(word) - 1) + 1)
        )

    def __contains__(self, word: str) -> bool:
        return word in self.all_words or self.learned(word)


def features(text: str | None, lexicon: Lexicon) -> tuple[float, ...]:
    if not text:
        return (0.0,) * len(FEATURES)
    words = text.lower().split()
    n = len(words)
    if not n:
        return (0.0,) * len(FEATURES)
    bare = [word.strip(EDGE) for word in words]
    known = set(bare)
    heads = lexicon.heads
    insults = {word for word in known if word[:SHORTEST] in heads and word in lexicon}
    odd = [word for word in known if not word.isalpha() and _MIXED.search(word)]
    hidden = {word for word in odd if word not in insults and _plain(word) in lexicon}
    hits = [place for place, word in enumerate(bare) if word in insults] if insults else []
    disguised = [place for place, word in enumerate(bare) if word in hidden] if hidden else []
    pronouns = [] if SECOND_PERSON.isdisjoint(known) else [p for p, word in enumerate(bare) if word in SECOND_PERSON]
    found = sorted(hits + disguised)
    near = 0
    if pronouns and found:
        told = set(pronouns)
        near = sum(not told.isdisjoint(range(p - NEAR, p + NEAR + 1)) for p in found)
    chars = len(text)
    marks = sum(map(text.count, ".,;:!?"))
    capitals = len(_CAPITAL.findall(text))
    shouted = sum(len(word) > 2 and word.isupper() for word in text.split()) if capitals > n / 2 else 0
    digits = sum(map(text.count, "0123456789"))
    return (
        math.log1p(n),
        float(min(len(found), 20)),
        100 * len(found) / n,
        float(min(sum(map(lexicon.learned, (bare[p] for p in hits))), 20)),
        float(len(insults) + len(hidden)),
        (found[-1] - found[0]) / n if found else 0.0,
        float(near),
        100 * len(pronouns) / n,
        float(len(disguised)),
        100 * len(odd) / n,
        capitals / chars,
        shouted / n,
        100 * text.count("!") / chars,
        marks / chars,
        digits / chars,
        100 * sum(map(text.count, ("!!!", "???", "..."))) / chars,
        1 - len(known) / n,
    )


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def checksum(text: Column) -> Column:
    return F.crc32(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def described(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, checksum of the text, features) of every row."""
    schema = "doc_id long, text_crc long, " + ", ".join(f"{name} double" for name in FEATURES)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([features(text, lexicon) for text in batch["text"]], columns=list(FEATURES))
            found.insert(0, "doc_id", batch["doc_id"].array)
            found.insert(1, "text_crc", batch["text_crc"].array)
            yield found

    rows = docs.select(
        F.col("doc_id").cast("long"), checksum(F.col("text")).alias("text_crc"), F.col("text").cast("string")
    )
    return rows.mapInPandas(measured, schema)


def _known(labels: DataFrame) -> DataFrame:
    kind = F.col("toxic").cast("double")
    return (
        labels.filter(F.col("doc_id").isNotNull() & kind.isin(0.0, 1.0))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(kind).alias("toxic"))
        .filter(fold(F.col("doc_id")) != 0)
    )


def _terms(text: str) -> tuple[int, set[str]]:
    """A sketch that near copies mostly share, and the terms of a text: words, and beginnings ending in ``*``."""
    words = [word.strip(EDGE) for word in text.lower().split()]
    windows = zip(words, words[1:], words[2:]) if len(words) > 2 else [tuple(words)]
    sketch = min(zlib.crc32(" ".join(window).encode("utf-8", "replace")) for window in windows)
    found = {word for word in words if len(word) >= SHORTEST}
    found |= {word[:n] + "*" for word in found for n in range(SHORTEST, min(LONGEST, len(word) - 1) + 1)}
    return sketch, found


def learn_lexicon(
    docs: DataFrame, labels: DataFrame, *, rows: int = LEXICON_ROWS, terms: int = LEARNED_TERMS
) -> Lexicon:
    """Terms that mark toxic texts, from at most ``rows`` labelled rows of each kind."""
    known = _known(labels)
    order = F.xxhash64("doc_id", F.lit(5))
    kinds = [known.filter(F.col("toxic") == kind).orderBy(order, "doc_id").limit(rows) for kind in (0.0, 1.0)]
    drawn = F.broadcast(kinds[0].unionByName(kinds[1]))  # at most 2 * rows pairs of numbers
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(drawn, "doc_id")

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = [_terms(text or "") for text in batch["text"]]
            yield pd.DataFrame(
                {"toxic": batch["toxic"], "sketch": [k[0] for k in known], "terms": [sorted(k[1]) for k in known]}
            )

    once = texts.mapInPandas(sketched, "toxic double, sketch long, terms array<string>")
    once = stored(once.groupBy("toxic", "sketch").agg(F.first("terms").alias("terms")), "toxic-terms")
    toxic, clean = once.agg(
        F.count(F.when(F.col("toxic") == 1, 1)), F.count(F.when(F.col("toxic") == 0, 1))
    ).first()
    if not toxic or not clean:
        return Lexicon()
    counts = (
        once.select("toxic", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(
            F.count(F.when(F.col("toxic") == 1, 1)).alias("bad"), F.count(F.when(F.col("toxic") == 0, 1)).alias("good")
        )
        .filter("bad >= 5")
    )
    # How far the toxic texts with a term exceed what its clean ones let expect, in standard deviations.
    expected = F.col("good") * (toxic / clean)
    excess = ((F.col("bad") - expected) / F.sqrt(expected + 1)).alias("excess")
    best = (
        counts.select("term", "bad", "good", excess)
        .filter((F.col("excess") >= 5) & (F.col("bad") >= 20 * expected))
        .orderBy(F.desc("excess"), F.length("term"), "term")
        .limit(8 * terms)
        .collect()
    )
    words: set[str] = set()
    beginnings: set[str] = set()
    for term in (row["term"] for row in best):
        stem = term.rstrip("*")
        covered = any(stem[:n] in beginnings for n in range(SHORTEST, len(stem) + (1 if stem == term else 0)))
        if not covered and len(words) + len(beginnings) < terms:
            (words if stem == term else beginnings).add(stem)
    return Lexicon(frozenset(words), frozenset(beginnings))


class Model:
    """Trees and calibration; ``rate`` alone where there was nothing to learn from."""

    def __init__(self, rate: float, trees=None, calibration=None):
        self.rate, self.trees, self.calibration = rate, trees, calibration

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``score``, the probability of a toxic label."""
        if self.trees is None:
            return rows.withColumn("score", F.lit(float(self.rate)))
        judged = _margins(self.trees, rows)
        return self.calibration.transform(judged).withColumn(
            "score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score"))
        )


def _margins(trees, rows: DataFrame) -> DataFrame:
    inputs = VectorAssembler(inputCols=list(FEATURES), outputCol="_inputs")
    judged = trees.transform(inputs.transform(rows))
    return judged.withColumn("_margin", vector_to_array("rawPrediction")[1]).drop(
        "_inputs", "rawPrediction", "probability", "_class"
    )


def fit(rows: DataFrame, labels: DataFrame, *, max_rows: int = MAX_TRAINING_ROWS, rounds: int = 20) -> Model:
    """Learn from the labelled ones of ``rows`` (``described``)."""
    once = rows.filter(F.col("doc_id").isNotNull()).join(_known(labels), "doc_id")
    count, toxic = once.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0.0))).first()
    if not 0 < toxic < count:
        return Model(toxic / count if count else 0.0)
    # A hash decides which rows to learn from, so reruns agree; the bound holds up to chance.
    share = min(1.0, max_rows / count)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_003)) < F.lit(int(share * 1_000_003) + 1)
    sample = stored(once.filter(drawn).repartition(8, "doc_id").sortWithinPartitions("doc_id", *FEATURES), "toxic")
    part = fold(F.col("doc_id"))
    train, check = sample.filter(part != 1), sample.filter(part == 1)
    kinds = train.agg(F.countDistinct("toxic")).first()[0]
    if kinds < 2:
        return Model(toxic / count)
    inputs = VectorAssembler(inputCols=list(FEATURES), outputCol="_inputs")
    trees = GBTClassifier(
        featuresCol="_inputs",
        labelCol="toxic",
        predictionCol="_class",
        maxIter=rounds,
        maxDepth=3,
        stepSize=0.3,
        minInstancesPerNode=5,
        seed=11,
    ).fit(inputs.transform(train))
    if not check.head(1):
        check = train
    steps = (
        _margins(trees, check)
        .groupBy(F.round("_margin", 3).alias("_margin"))
        .agg(F.avg("toxic").alias("toxic"), F.count("*").cast("double").alias("weight"))
    )
    calibration = IsotonicRegression(
        featuresCol="_margin", labelCol="toxic", weightCol="weight", predictionCol="score"
    ).fit(steps)
    return Model(toxic / count, trees, calibration)


def judge(docs: DataFrame, labels: DataFrame, **limits: int) -> DataFrame:
    """(doc_id, text_crc, features, score) of every row."""
    labels = stored(labels.select("doc_id", "toxic"), "toxic-labels")
    rows = stored(described(docs, learn_lexicon(docs, labels)), "toxic-features")
    return fit(rows, labels, **limits).score(rows)


def scored(docs: DataFrame, labels: DataFrame, **limits: int) -> DataFrame:
    """A row per document: ``held_out``, ``score`` and ``predicted``."""
    return judge(docs, labels, **limits).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def reject(docs: DataFrame, labels: DataFrame, **limits: int) -> DataFrame:
    """``docs`` without those that are predicted to be toxic.

    The text's own checksum stands beside the id, so versions of one document are judged apart.
    """
    keyed = without(docs, ["_crc"]).withColumn("_crc", checksum(F.col("text")))
    toxic = judge(docs, labels, **limits).filter("score >= 0.5")
    bad = toxic.select(F.col("doc_id").alias("_id"), "text_crc").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_crc") == F.col("text_crc"))
    return keyed.join(bad, same, "left_anti").drop("_crc")
