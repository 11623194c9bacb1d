"""License scans: MinHash bands over overlapping text windows find templates, shingle containment verifies them.

Words are runs of letters and digits in lower case, shingles five words (the whole notice where a template is
shorter). A template of n shingles is sought in windows of two strides, the stride being n or the next number
that blocks divide. A notice counts where at least 80 percent of the template's distinct shingles stand in an area of three
strides in a row: an unbroken notice lies inside some area, and so does one that is parted by a foreign passage of up to a
stride less some words. An area is two overlapping windows, one of which holds half of what the area holds: at least 40 percent.
The signature of a window has one minimum per band (rows of one: a band that agrees shares a shingle), each of a hash with
a seed of its own. The number of bands follows from the least similarity of a window with 40 percent: the chance that all bands
differ is below ``MISS``. Windows that agree with a template in a band are candidates; the two areas that
a candidate is part of are verified on their shingles.

A text without any of the ``anchors``, long words of which every area that counts holds one, cannot hold a
notice; it is passed over before its words are cut. Minima are taken over blocks of
``BLOCK`` shingles once; those of longer blocks and of windows are minima of minima.
Everything happens inside a document's row, with built-in functions; only rows with a candidate go on, and only
findings are shuffled.

Defined results: null, empty and short texts have no findings and no row; rows with a null id are reported under the null
id; rows that share an id are reported together with the best containment of any; an empty table gives an
empty result; columns other than ``doc_id`` and ``text`` are left behind.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.license_texts import NOTICES

SHINGLE, BLOCK = 5, 4
CONTAINMENT, MISS = 0.8, 1e-4
_BREAK = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class Template:
    name: str
    license: str
    words: tuple[str, ...]

    @property
    def width(self) -> int:
        return min(SHINGLE, len(self.words))

    @property
    def shingles(self) -> tuple[tuple[str, ...], ...]:
        """The distinct shingles, in order."""
        starts = range(len(self.words) - self.width + 1)
        return tuple(dict.fromkeys(self.words[start : start + self.width] for start in starts))

    @property
    def stride(self) -> int:
        n = len(self.words) - self.width + 1
        return n if n == 1 else -(-n // BLOCK) * BLOCK if n <= 2 * BLOCK else -(-n // (2 * BLOCK)) * 2 * BLOCK

    @property
    def window(self) -> int:
        return 1 if self.stride == 1 else 2 * self.stride

    @property
    def area(self) -> int:
        return 1 if self.stride == 1 else 3 * self.stride

    @property
    def bands(self) -> int:
        """Enough for the better window of an area with the least containment that counts to agree in some band."""
        if self.window == 1:
            return 1
        n = len(self.shingles)
        shared = math.ceil(math.ceil(CONTAINMENT * n) / 2)
        least = shared / (self.window + n - shared)
        return math.ceil(math.log(MISS) / math.log(1 - least))


def templates(notices: dict[str, tuple[str, str]] = NOTICES) -> list[Template]:
    return [
        Template(name, license, tuple(re.findall(r"[^\W_]+", text.lower()))) for name, (license, text) in notices.items()
    ]


def anchors(known: list[Template]) -> list[str]:
    """Long words, of which every area that counts holds one.

    Containment leaves out at most n - ceil(0.8 n) of a template's n shingles, so one of any larger number of them
    is there; the words of a template's list stand in so many of its shingles.
    """
    chosen: set[str] = set()
    for t in known:
        needed = len(t.shingles) - math.ceil(CONTAINMENT * len(t.shingles)) + 1
        covered: set[tuple[str, ...]] = set()
        for word in sorted(set(t.words), key=lambda w: (-len(w), w)):
            if len(covered) >= needed:
                break
            covered |= {s for s in t.shingles if word in s}
            chosen.add(word)
    return sorted(w for w in chosen if not any(other != w and other in w for other in chosen))


def _hashed(spark: SparkSession, known: list[Template], bands: int) -> tuple[dict[str, list[int]], dict[str, list[int]]]:
    """Spark's own hashes of the templates' shingles, and their least in each band."""
    rows = [(t.name, list(s)) for t in known for s in t.shingles]
    found: dict[str, list[int]] = {t.name: [] for t in known}
    df = spark.createDataFrame(rows, "name string, words array<string>")
    by_width = F.when(F.size("words") == SHINGLE, _shingle_hash(F.col("words"), F.lit(0), SHINGLE))
    for width in {t.width for t in known} - {SHINGLE}:
        by_width = by_width.when(F.size("words") == width, _shingle_hash(F.col("words"), F.lit(0), width))
    least: dict[str, list[int]] = {}
    for name, value, banded in df.select("name", by_width.alias("h")).select("name", "h", _banded(F.col("h"), bands)).collect():
        found[name].append(value)
        least[name] = [min(pair) for pair in zip(least.get(name, banded), banded)]
    return found, least


def _banded(value: Column, bands: int) -> Column:
    """The value's hash in each band, a function of its own for every seed."""
    return F.transform(_upto(F.lit(bands)), lambda seed: F.xxhash64(value, seed))


def _shingle_hash(words: Column, start: Column, width: int) -> Column:
    return F.xxhash64(*[F.get(words, start + place) for place in range(width)])


def _least(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.least(x, y))


def _joined_blocks(blocks: Column, by: int) -> Column:
    """Minima of ``by`` blocks at a time."""
    count = F.ceil(F.size(blocks) / by).cast("int")
    return F.transform(
        _upto(count),
        lambda k: F.aggregate(F.slice(blocks, k * by + 2, by - 1), F.get(blocks, k * by), _least),
    )


def _upto(count: Column) -> Column:
    """0 to ``count`` - 1."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, known: list[Template] | None = None) -> DataFrame:
    """(doc_id, template, license, containment) of the notices found."""
    known = templates() if known is None else known
    long = [t for t in known if t.window > 1 and t.width == SHINGLE]
    bands = max((t.bands for t in long), default=0)
    hashes, least = _hashed(docs.sparkSession, known, bands)
    lowered = docs.select(F.col("doc_id").cast("long"), F.lower(F.col("text").cast("string")).alias("text"))
    words = F.filter(F.split("text", _BREAK), lambda w: w != "")
    rows = lowered.filter(F.col("text").rlike("|".join(anchors(known)))).select("doc_id", words.alias("words"))
    for width in sorted({t.width for t in known} | {SHINGLE}):
        starts = _upto(F.size("words") - (width - 1))
        rows = rows.withColumn(f"h{width}", F.transform(starts, lambda s: _shingle_hash(F.col("words"), s, width)))
    rows = rows.drop("words")

    h, h_col = f"h{SHINGLE}", F.col(f"h{SHINGLE}")
    blocks = F.transform(
        _upto(F.ceil(F.size(h) / BLOCK).cast("int")),
        lambda k: F.transform(
            F.array(F.slice(h_col, k * BLOCK + 1, BLOCK)),
            lambda block: F.transform(
                _upto(F.lit(bands)), lambda seed: F.array_min(F.transform(block, lambda x: F.xxhash64(x, seed)))
            ),
        )[0],
    )
    rows = rows.withColumn(f"b{BLOCK}", blocks)
    strides = sorted({t.stride for t in long})
    if any(s > BLOCK for s in strides):
        rows = rows.withColumn(f"b{2 * BLOCK}", _joined_blocks(F.col(f"b{BLOCK}"), 2))
    for stride in strides:
        if stride > 2 * BLOCK:
            rows = rows.withColumn(f"b{stride}", _joined_blocks(F.col(f"b{2 * BLOCK}"), stride // (2 * BLOCK)))

    # Candidate windows of each stride, by the number of their first block.
    groups: dict[tuple[int, int], list[Template]] = {}
    for t in known:
        groups.setdefault((t.width, t.stride), []).append(t)
    kept = ["doc_id", *[f"h{width}" for width in sorted({t.width for t in known} | {SHINGLE})]]
    candidates = []
    for (width, stride), own in groups.items():
        name = f"c{width}_{stride}"
        if own[0].window == 1:
            values = [v for t in own for v in hashes[t.name]]
            hit = _single_hits(f"h{width}", values)
        else:
            hit = _band_hits(f"b{stride}", [v for t in own for v in least[t.name]])
        candidates.append(hit.alias(name))
    found = rows.select(*kept, *candidates)
    # Verified in the row itself. An outer explode infers no filter that would compute all of this twice.
    verified = []
    for (width, stride), own in groups.items():
        for t in own:
            verified.append(
                F.transform(F.col(f"c{width}_{stride}"), _containment(t, F.col(f"h{width}"), hashes[t.name]))
            )
    enough = F.filter(F.concat(*verified), lambda v: v["containment"] >= CONTAINMENT)
    matched = found.select("doc_id", F.explode_outer(enough).alias("hit")).select("doc_id", "hit.*")
    license_of = F.create_map(*[F.lit(x) for t in known for x in (t.name, t.license)])
    return (
        matched.filter(F.col("template").isNotNull())
        .groupBy("doc_id", "template")
        .agg(F.max("containment").alias("containment"))
        .withColumn("license", F.element_at(license_of, F.col("template")))
        .select("doc_id", "template", "license", "containment")
    )


def _containment(t: Template, column: Column, values: list[int]):
    """The larger share of the template's shingles in the areas that window ``k`` begins and ends."""
    wanted = F.array(*[F.lit(v) for v in values])

    def held(first: Column) -> Column:
        return F.size(F.array_intersect(wanted, F.slice(column, first * t.stride + 1, t.area)))

    def of(k: Column) -> Column:
        common = held(k) if t.window == 1 else F.greatest(held(k), held(F.greatest(k - 1, F.lit(0))))
        return F.struct(F.lit(t.name).alias("template"), (common / F.lit(float(len(values)))).alias("containment"))

    return of


def _single_hits(column: str, values: list[int]) -> Column:
    """Places whose shingle is one of the values."""
    marked = F.transform(F.col(column), lambda x, k: F.when(x.isin(values), k))
    return F.array_compact(marked)


def _band_hits(column: str, minima: list[int]) -> Column:
    """Numbers of the windows, two blocks each, of which some band agrees with a template."""
    blocks = F.col(column)
    windows = F.transform(
        _upto(F.greatest(F.size(blocks) - 1, F.least(F.size(blocks), F.lit(1)))),
        lambda k: F.when(
            F.exists(
                F.when(F.get(blocks, k + 1).isNull(), F.get(blocks, k)).otherwise(
                    _least(F.get(blocks, k), F.get(blocks, k + 1))
                ),
                lambda x: x.isin(minima),
            ),
            k,
        ),
    )
    return F.array_compact(windows)
