"""Quality rules kept as a bitmask ledger.

Every rule is evaluated once per document. Its failure is one bit of ``failed``, its measurement a
column. A policy is a named, versioned set of rules, that is a mask: applying or changing one, or asking
what a rule alone decides, reads the ledger and not the texts.

Defined results: a null text has no words; an empty or null text fails the length rule; rows are judged
one by one, so repeated ids and ties do not matter; an empty table gives an empty ledger; only ``doc_id``
and ``text`` are read, other columns are left behind.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
_NO_LETTER = re.compile(r"[\W\d_]")
_CAPITAL = re.compile("[A-ZÀ-ÖØ-Þ]")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_capitals")
LEDGER = "doc_id long, " + ", ".join(f"{name} long" for name in MEASURES)


# The rules; the place of a name is its bit, ``conditions`` says when a document fails it.
RULES = (
    "too_few_words",
    "repeated_passages",
    "symbol_rate",
    "repeated_lines",
    "word_length",
    "few_letters",
    "mostly_capitals",
)
# Policies by version. The first holds the two rules that every later one keeps.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_passages"),
    "v1": ("too_few_words", "repeated_passages", "symbol_rate", "repeated_lines"),
    # Short clean texts repeat a line now and then; the passage rule above finds what is really repetitive.
    "v2": ("too_few_words", "repeated_passages", "symbol_rate", "word_length", "few_letters", "mostly_capitals"),
}
CURRENT = "v2"


def conditions() -> dict[str, Column]:
    words, chars = F.col("n_words"), F.col("word_chars")
    return {
        "too_few_words": words < 50,
        "repeated_passages": 100 * F.col("n_repeat_words") > 50 * words,
        "symbol_rate": 20 * F.col("n_symbols") > chars,
        "repeated_lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
        "word_length": (chars < 2 * words) | (chars > 25 * words),
        "few_letters": 2 * F.col("n_letters") < chars,
        "mostly_capitals": 2 * F.col("n_capitals") > F.col("n_letters"),
    }


def _letters(text: str) -> int:
    """Characters of a letter category. The pattern also leaves signs such as ½, which ASCII does not have."""
    return len(text) - len(_NO_LETTER.findall(text)) if text.isascii() else sum(map(str.isalpha, text))


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at the very six separators
    filled = [line for line in text.split("\n") if line.strip(SPACES)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts, end = Counter(windows), 0
        for start, window in enumerate(windows):
            if counts[window] > 1:
                repeated += start + 3 - max(start, end)
                end = start + 3
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(filled) - len(set(filled)),
        repeated,
        len(filled),
        _letters(text),
        len(_CAPITAL.findall(text)),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: its measurements and ``failed``, one bit per rule."""

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([measure(t) for t in batch["text"]], columns=list(MEASURES), dtype="int64")
            found.insert(0, "doc_id", batch["doc_id"].array)
            yield found

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(measured, LEDGER)
    bits = [
        F.when(condition, F.lit(1 << bit)).otherwise(F.lit(0)) for bit, condition in enumerate(conditions().values())
    ]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return rows.withColumn("failed", failed.cast("long"))


def mask(policy: str | tuple[str, ...]) -> int:
    names = POLICIES[policy] if isinstance(policy, str) else policy
    return sum(1 << RULES.index(name) for name in names)


def passes(policy: str | tuple[str, ...]) -> Column:
    """Whether a ledger row keeps its document under the policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy))) == 0


def ablations(rows: DataFrame, policy: str | tuple[str, ...] = CURRENT) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that it alone rejects; one pass over the ledger."""
    names = POLICIES[policy] if isinstance(policy, str) else policy
    hit = F.col("failed").bitwiseAND(F.lit(mask(policy)))
    sums = []
    for name in names:
        bit = mask((name,))
        sums += [
            F.count(F.when(hit.bitwiseAND(F.lit(bit)) != 0, 1)).alias(f"{name}_fails"),
            F.count(F.when(hit == bit, 1)).alias(f"{name}_alone"),
        ]
    wide = rows.agg(*sums)
    pairs = ", ".join(f"'{name}', `{name}_fails`, `{name}_alone`" for name in names)
    return wide.selectExpr(f"stack({len(names)}, {pairs}) as (rule, fails, rejects_alone)")
