"""Secret scans over an incremental ledger of blobs.

A text is stored under its content address, the SHA-256 of its bytes. The path table lists every version of every
document with its address; the findings table holds one row per address and rule version that
has been scanned, found or not. A scan takes the pairs of address and rule version that the findings
table lacks, reads each of those texts once, however many paths show it, and joins findings back to all paths.
Only built-in functions are used.

Spans are found in two parallel lists per rule: the pieces between matches (``split``) and the matches
(``regexp_extract_all``). Their lengths, added up along the text, give start and end in code points.

Defined results: a null text is scanned as the empty one; null ids are paths like any other; equal rows are
rows of their own; an empty table gives an empty result; columns other than ``doc_id`` and ``text``
are left behind by ``scan`` and kept by ``redact`` (input columns named like its own are replaced).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import stored, without
from shelfline.session import shared_dir


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``measured``: the group whose length must be ``shortest`` at least (0: the match)."""

    kind: str
    pattern: str
    measured: int = 0
    shortest: int = 1


# The three base rules, in their order. A match of hex or access that is too short holds no longer
# one, so the lower bound stands in the pattern; a match of assign that is too short uses its text up.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        measured=2,
        shortest=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# A private key runs to its END line if what lies between is header lines (up to 200; more make no key) and then base64, which
# begins with an unbroken run of 16 and may be cut into lines by breaks, written-out breaks, quotes, signs that join
# strings, or signs that start a comment. Where the END line is missing it runs over header lines and the lines of base64, of
# which the last may be short. In all other cases, as in prose about such keys, the mark itself is the span. Classes, not
# groups, take the long stretches: Java's search would go one call deeper for each turn of a group.
_KEY_HEADERS = r"(?:[ \t]*(?:\r?\n|\\r\\n|\\n)[ \t]*[A-Z][A-Za-z-]*:[^\r\n\\]*){0,200}"
_KEY_BODY = (
    rf"(?:{_KEY_HEADERS}[nr\"',;#*>|+\\ \t\r\n]*[A-Za-z0-9+/]{{16,}}[A-Za-z0-9+/=\"',;#*>|\\ \t\r\n]*-----END [A-Z ]{{0,30}}PRIVATE KEY-----"
    rf"|{_KEY_HEADERS}"
    r"(?:[ \t]*(?:[\r\n]|\\[rn])(?:[A-Za-z0-9+/\\\r\n]*|[\r\n]*[ \t]+[A-Za-z0-9+/\\\r\n \t]*)[A-Za-z0-9+/]{16,}={0,2}"
    r"(?:\r?\n[ \t]*[A-Za-z0-9+/]{1,15}(?:={1,2}|\r?\n))?)?)"
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----" + _KEY_BODY),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = (*BASE_RULES, *MORE_RULES)
VERSION = "4"
SPAN = "struct<start:long,rank:int,end:long>"


def address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def find_spans(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, spans) of the texts (blob, text) that hold any; spans sorted by start, then rule."""
    parts = []
    for rank, rule in enumerate(rules):
        pattern = F.lit(rule.pattern)
        cut = F.transform(F.split("text", rule.pattern, -1), F.char_length)
        whole = F.transform(F.regexp_extract_all("text", pattern, F.lit(0)), F.char_length)
        judged = F.transform(F.regexp_extract_all("text", pattern, F.lit(rule.measured)), F.char_length)
        parts.append(
            texts.filter(F.col("text").rlike(rule.pattern))
            .select("blob", F.posexplode(F.arrays_zip(cut.alias("gap"), whole.alias("long"), judged.alias("judged"))))
            .select("blob", "pos", "col.*", F.lit(rank).alias("rank"), F.lit(rule.shortest).alias("shortest"))
        )
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    along = Window.partitionBy("blob", "rank").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.coalesce("long", F.lit(0))).over(along)
    spans = (
        found.withColumn("end", end.cast("long"))
        .filter(F.col("judged") >= F.col("shortest"))
        .withColumn("start", F.col("end") - F.col("long"))
    )
    return spans.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "end"))).alias("spans"))


class Ledger:
    """Paths and findings below a shared folder; each scan adds a folder of its own to both."""

    def __init__(self, spark, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def findings(self) -> DataFrame:
        """(rule_version, blob, spans) of all that has been scanned; a pair that two scans have written counts once."""
        kind = f"rule_version string, blob string, spans array<{SPAN}>"
        return self._read("findings", kind).dropDuplicates(["rule_version", "blob"])

    def paths(self) -> DataFrame:
        """(doc_id, blob) of every version of every document."""
        return self._read("paths", "doc_id long, blob string").distinct()

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.root}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def scan(self, docs: DataFrame, rules: Sequence[Rule] = RULES, version: str = VERSION) -> DataFrame:
        """Scan what is new in ``docs`` and return (doc_id, blob, spans) for every row of it."""
        addressed = docs.select(
            F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
        ).withColumn("blob", address(F.col("text")))
        paths = addressed.select("doc_id", "blob")
        step = shared_dir(self.spark, "scan").rsplit("/", 1)[1]
        paths.write.parquet(f"{self.root}/paths/{step}")
        listed = self.spark.read.schema(paths.schema).parquet(f"{self.root}/paths/{step}")

        known = self.findings().filter(F.col("rule_version") == version).select("blob")
        # Addresses are made distinct within the tasks first, so one that a third of the paths share is spread; both
        # sides of the join are then unique.
        new = listed.select("blob").distinct().join(known, "blob", "left_anti")
        # Only texts that hold a match are moved, one of each address from a task.
        holding = reduce(or_, (F.col("text").rlike(rule.pattern) for rule in rules))
        texts = addressed.filter(holding).select("blob", "text").dropDuplicates(["blob"]).join(new, "blob", "left_semi")
        spans = find_spans(texts, rules)
        none = F.array().cast(f"array<{SPAN}>")
        scanned = (
            new.join(spans, "blob", "left")
            .select(F.lit(version).alias("rule_version"), "blob", F.coalesce("spans", none).alias("spans"))
        )
        scanned.write.parquet(f"{self.root}/findings/{step}")
        found = self.findings().filter((F.col("rule_version") == version) & (F.size("spans") > 0))
        return listed.join(found.select("blob", "spans"), "blob", "left").select(
            "doc_id", "blob", F.coalesce("spans", none).alias("spans")
        )


def merged(found: DataFrame) -> DataFrame:
    """(blob, stretches) of (blob, spans): the spans as disjoint stretches (start, end), in order."""
    along = Window.partitionBy("blob").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select("blob", F.posexplode("spans").alias("at", "span")).select("blob", "at", "span.*")
    opens = F.coalesce(F.col("start") > F.max("end").over(along), F.lit(True)).cast("int")
    counted = Window.partitionBy("blob").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        spans.withColumn("opens", opens)
        .withColumn("stretch", F.sum("opens").over(counted))
        .groupBy("blob", "stretch")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("blob")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("stretches"))
    )


def redact(docs: DataFrame, ledger: Ledger, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every stretch of found secrets replaced by ``mark``; scans what the ledger lacks."""
    docs = without(docs, ("_blob", "_spans"))
    found = ledger.scan(docs).filter(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"])
    found = merged(found).select(F.col("blob").alias("_blob"), F.col("stretches").alias("_spans"))
    # What stands before each stretch, then the mark; the last piece runs to the end of the text.
    stretches = F.col("_spans")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(stretches, lambda s: s["end"]))
    begins = F.concat(
        F.transform(stretches, lambda s: s["start"]), F.array(F.char_length("text").cast("long"))
    )
    pieces = F.transform(
        F.arrays_zip(ends.alias("a"), begins.alias("b")),
        lambda p: F.substring(F.col("text"), (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")),
    )
    clean = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(F.array_join(pieces, mark))
    joined = docs.withColumn("_blob", address(F.col("text"))).join(found, "_blob", "left")
    return joined.withColumn("_clean", clean).select(
        *[F.col("_clean").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    )
