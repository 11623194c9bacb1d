"""MinHash near-dedup with an LSH forest.

A document is the set of its 5-word shingles. Documents with equal sets are one class, named by a hash of
the set. Each class has a signature in each of ``TREES`` trees, the sequence of ``DEPTH`` minima of as many seeded hashes.
A tree is the order of all classes sorted by their signatures: the further two begin alike, the nearer they stand.

1. The orders are range-partitioned and sorted, and every class meets its neighbour on either side, with the length of
   their common prefix (LCP). Candidates of a class are the neighbour with the longest LCP in all trees, and the class of
   least name among those next to it that share their first ``FIRST`` values; confirmed candidates give first components.
2. A region is a stretch of an order whose signatures share their first ``FIRST`` values. Regions in which all
   classes are in one component are done. Where a region still holds more than ``crowded`` components it is parted by one
   more value, and so on as far as it is so dense: the depth is found region by region, down to ``DEPTH``.
3. Members that are not in the component of their region's pivot are compared with every member of the region that is in
   another component, so within regions nothing is left out: in small regions as listed pairs, in larger ones inside one join. Before that, ``turns`` may compare them with pivots drawn
   anew, which spares work where a region holds many components of one group of copies.

Two texts of Jaccard similarity 0.85 share no region of depth 3 with probability 2.4e-7 (at 0.8 1e-5), of depth 6 with
5e-4. Only pairs whose shared regions are all dense in components meet the deeper figure.

Links are confirmed on the full shingle sets, as 64-bit hashes of the five words.

Defined results: a text without words (null, empty, blank) has an empty set and is linked with nothing; a text of
fewer than five words is one shingle; rows with a null id are returned with a null component and not kept; rows that
share an id are one document that has the links of all of them; an empty table gives an empty result; other columns
are left behind by ``near_duplicates`` and kept by ``representatives``, which judges each version of an id by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import stored, without
from shelfline.llm.components import components

SHINGLE = 5
TREES, FIRST, DEPTH = 16, 3, 6
_PAIRED = 4  # members of a region up to which its pairs are listed
_MARKS = 1 << 24  # bits that keys are marked in
_VALUE = 2  # bytes of a minimum that a signature keeps
_CODE = "xxhash64(n, key_a, key_b) AS code"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_POWERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 1], dtype=np.uint64)
_SEEDS = np.random.default_rng(20_240_601).integers(1, 1 << 62, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    # Bytes split at the very six separators; only A-Z change their case.
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)], dtype=np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(word) for word in words], dtype=np.uint64)
    count = len(words) - SHINGLE + 1
    total = hashes[:count] * _POWERS[0]
    for place in range(1, SHINGLE):
        total = _mixed(total + hashes[place : place + count]) * _POWERS[place] if place < 4 else total + hashes[place:]
    return np.unique(_mixed(total))


def signatures(found: np.ndarray) -> list[bytes]:
    """The signature of a set in each tree: ``DEPTH`` values of two bytes, in an order that bytes are compared in."""
    minima = np.full(len(_SEEDS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(found), 512):
        block = found[start : start + 512, None] * _SEEDS
        np.minimum(minima, block.min(axis=0), out=minima)
    values = (_mixed(minima) >> np.uint64(64 - 8 * _VALUE)).astype(f">u{_VALUE}").reshape(TREES, DEPTH)
    return [row.tobytes() for row in values]


def _keys(found: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set."""
    spread = _mixed(found * _POWERS[2])
    return int(np.bitwise_xor.reduce(found).view(np.int64)), int(spread.sum(dtype=np.uint64).view(np.int64))


def _text_key() -> Column:
    return F.xxhash64(F.col("text").cast("string")).alias("text_key")


def _sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, code, n, signatures): a hash of the text, the name of its set's class, its size."""

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = shingles(text)
                rows.append((len(found), *_keys(found), signatures(found) if len(found) else []))
            out = pd.DataFrame(rows, columns=["n", "key_a", "key_b", "signatures"])
            out.insert(0, "doc_id", batch["doc_id"].array)
            out.insert(1, "text_key", batch["text_key"].array)
            yield out

    rows = docs.select(F.col("doc_id").cast("long"), _text_key(), F.col("text").cast("string"))
    schema = "doc_id long, text_key long, n long, key_a long, key_b long, signatures array<binary>"
    return rows.mapInPandas(sketched, schema).selectExpr("doc_id", "text_key", _CODE, "n", "signatures")


def _sets(texts: DataFrame) -> DataFrame:
    """(code, n, shingles) of the texts."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(text) for text in batch["text"]]
            keys = [_keys(s) for s in sets]
            yield pd.DataFrame(
                {
                    "n": [len(s) for s in sets],
                    "key_a": [k[0] for k in keys],
                    "key_b": [k[1] for k in keys],
                    "shingles": [s.view(np.int64) for s in sets],
                }
            )

    rows = texts.select("text").mapInPandas(found, "n long, key_a long, key_b long, shingles array<long>")
    return rows.selectExpr(_CODE, "n", "shingles")


def _similar(a: str, b: str, percent: int) -> Column:
    """Whether sets of such sizes can be similar enough at all."""
    return (100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a))


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _orders(classes: DataFrame) -> DataFrame:
    """(tree, signature, code, n): a row of each class in each tree."""
    return classes.select(F.posexplode("signatures").alias("tree", "signature"), "code", "n")


def _at_border(code: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"a": code.array, "b": code.array, "lcp": 0})


def _neighbours(orders: DataFrame) -> DataFrame:
    """(a, b, lcp) of classes that are next to each other in an order and share ``FIRST`` values at least.

    With an LCP of 0 each of a run of such classes comes with the run's least. Those at a partition's borders come with themselves: what stands beyond is not seen here, but their regions are looked at
    later like any other.
    """

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for batch in batches:
            if last is None:
                yield _at_border(batch["code"].iloc[:1])
            else:
                batch = pd.concat([last, batch], ignore_index=True)
            last = batch.iloc[-1:]
            values = np.frombuffer(b"".join(batch["signature"]), dtype=f">u{_VALUE}").reshape(-1, DEPTH)
            same = np.cumprod(values[1:] == values[:-1], axis=1).sum(axis=1)
            same[batch["tree"].to_numpy()[1:] != batch["tree"].to_numpy()[:-1]] = 0
            code, near = batch["code"].to_numpy(), same >= FIRST
            yield pd.DataFrame({"a": code[:-1][near], "b": code[1:][near], "lcp": same[near]})
            runs = np.flatnonzero(np.r_[True, ~near])
            least = np.repeat(np.minimum.reduceat(code, runs), np.diff(np.r_[runs, len(code)]))
            others = least != code
            yield pd.DataFrame({"a": least[others], "b": code[others], "lcp": 0})
        if last is not None:
            yield _at_border(last["code"])

    by = ["tree", "signature", "code"]
    rows = orders.select(*by).repartitionByRange(*by).sortWithinPartitions(*by)
    return rows.mapInPandas(met, "a long, b long, lcp long")


def _candidates(met: DataFrame) -> DataFrame:
    """(a, b): every class with the neighbour of the longest common prefix in all trees, and with the least of its runs."""
    least, met = met.filter("lcp = 0 AND a <> b"), met.filter("lcp > 0")
    both = met.unionByName(met.select(F.col("b").alias("a"), F.col("a").alias("b"), "lcp"))
    best = both.groupBy("a").agg(F.max(F.struct("lcp", "b")).alias("best"))
    nearest = best.select("a", F.col("best.b").alias("b"))
    return nearest.unionByName(least.select("a", "b")).select(*_ordered("a", "b")).distinct()


def _regions(orders: DataFrame, met: DataFrame, parts: DataFrame, crowded: int) -> DataFrame:
    """(region, code, n) of the classes in every region that holds several components."""
    alone = parts.select(F.col("node").alias("code"), F.col("component").alias("own"))
    near = met.select(F.col("a").alias("code")).unionByName(met.select(F.col("b").alias("code"))).distinct()
    rows = orders.join(near, "code", "left_semi").join(alone, "code", "left").withColumn("own", F.coalesce("own", "code"))
    found = None
    for depth in range(FIRST, DEPTH + 1):
        placed = rows.withColumn("prefix", F.substring("signature", 1, depth * _VALUE))
        sizes = placed.groupBy("tree", "prefix").agg(F.count_distinct("own").alias("apart"))
        # Regions of one component are done.
        placed = stored(placed.join(sizes.filter("apart > 1"), ["tree", "prefix"]), "regions")
        settled = placed if depth == DEPTH else placed.filter(F.col("apart") <= crowded)
        named = settled.select(F.xxhash64("tree", "prefix", F.lit(depth)).alias("region"), "code", "n")
        found = named if found is None else found.unionByName(named)
        rows = placed.filter(F.col("apart") > crowded).select("tree", "signature", "code", "n", "own")
        if not rows.head(1):
            break
    return found


def _marked(rows: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """``rows`` with ``_mark``: false where their keys are surely not in ``wanted``, so that such rows need no join.

    The marks are bits at hashes of the keys, in at most ``_MARKS`` / 64 rows, which every task gets.
    """
    at = F.pmod(F.xxhash64(*keys), F.lit(_MARKS))
    word, bit = F.floor(at / 64).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
    marks = wanted.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    found = rows.withColumn("_word", word).join(F.broadcast(marks), "_word", "left")
    return found.withColumn("_mark", F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))).drop("_word", "_bits")


def _class_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(code, n, shingles) of the classes in ``wanted`` (code)."""
    ids = stored(classes.join(wanted, "code", "left_semi").select("doc_id").distinct(), "wanted-ids")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = _marked(texts, ["doc_id"], ids).filter("_mark").drop("_mark").join(ids, "doc_id", "left_semi")
    # An id may name several versions, and a version may stand there twice.
    return _sets(texts).join(wanted, "code", "left_semi").dropDuplicates(["code"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of classes whose sets are similar enough."""
    left = sets.select(F.col("code").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("code").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    common = F.size(F.array_intersect("s_a", "s_b")).alias("common")
    compared = pairs.join(left, "a").join(right, "b").select("a", "b", common, (F.col("n_a") + F.col("n_b")).alias("both"))
    return compared.filter(_enough(F.col("common"), F.col("both"), percent)).select("a", "b")


def _merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``parts`` (node, component) with more links."""
    for side in ("a", "b"):
        at = parts.select(F.col("node").alias(side), F.col("component").alias("_at"))
        links = links.join(at, side, "left").withColumn(side, F.coalesce("_at", side)).drop("_at")
    links = stored(links.filter("a <> b").distinct(), "merges")
    if not links.head(1):
        return parts
    tops = components(links).select(F.col("node").alias("component"), F.col("component").alias("top"))
    moved = parts.join(tops, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    # Classes that had no link before are roots of their own.
    fresh = tops.join(parts.select(F.col("node").alias("component")), "component", "left_anti")
    fresh = fresh.select(F.col("component").alias("node"), F.col("top").alias("component"))
    return stored(moved.unionByName(fresh), "merged")


def _placed(regions: DataFrame, parts: DataFrame) -> DataFrame:
    """The members of the regions with their components."""
    own = parts.select(F.col("node").alias("code"), F.col("component").alias("own"))
    return regions.join(own, "code", "left").select("region", "code", "n", F.coalesce("own", "code").alias("own"))


def _far_from_pivot(placed: DataFrame, turn: int) -> DataFrame:
    """Members in another component than their region's pivot of this turn: (region, code, n, own, pivot, pivot_n)."""
    drawn = F.min(F.struct(F.xxhash64("code", "region", F.lit(turn)).alias("_"), "code", "n", "own")).alias("pivot")
    pivots = placed.groupBy("region").agg(drawn)
    return placed.join(pivots, "region").filter(F.col("own") != F.col("pivot.own")).select(
        "region", "code", "n", "own", F.col("pivot.code").alias("pivot"), F.col("pivot.n").alias("pivot_n")
    )


def _enough(common: Column, both: Column, percent: int) -> Column:
    return 100 * common >= percent * (both - common)


def _across(placed: DataFrame, odd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of each odd member with members of its regions that are in another component.

    The exact test stands in the join's condition, so pairs that fail it are never written. Two members may
    share regions of several trees: only the first of these, by the regions' own order, tests the pair.
    """
    all_of = placed.join(odd.select("region").distinct(), "region", "left_semi")
    lists = all_of.groupBy("code").agg(F.sort_array(F.collect_set("region")).alias("all"))  # at most one per order
    members = all_of.join(lists, "code").join(sets.select("code", "shingles"), "code")
    left = members.join(odd.select("region", "code"), ["region", "code"], "left_semi").select(
        F.col("region").alias("same"),
        F.col("code").alias("c"),
        F.col("n").alias("m"),
        F.col("own").alias("at"),
        F.col("all").alias("every"),
        F.col("shingles").alias("other"),
    )
    first = F.array_min(F.array_intersect("all", "every")) == F.col("region")
    apart = (F.col("own") != F.col("at")) & _similar("n", "m", percent) & first
    linked = _enough(F.size(F.array_intersect("shingles", "other")), F.col("n") + F.col("m"), percent)
    found = members.join(left, (F.col("region") == F.col("same")) & apart & linked)
    return found.select(*_ordered("code", "c")).distinct()


def _links(placed: DataFrame, odd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of each odd member with members of its regions that are in another component.

    In small regions the pairs are listed, each once for all trees, and only then meet their sets: there are at most
    ``_PAIRED`` times as many as members. In larger ones the sets are sent to the regions.
    """
    sizes = placed.groupBy("region").agg(F.count("*").alias("members"))
    few = sizes.filter(F.col("members") <= _PAIRED).select("region")
    left = odd.join(few, "region", "left_semi").select(
        "region", F.col("code").alias("c"), F.col("n").alias("m"), F.col("own").alias("at")
    )
    pairs = placed.join(left, "region").filter((F.col("own") != F.col("at")) & _similar("n", "m", percent))
    listed = stored(pairs.select(*_ordered("code", "c")).distinct(), "listed")
    links = _confirmed(listed, sets, percent)
    crowded = sizes.filter(F.col("members") > _PAIRED).select("region")
    rest = stored(placed.join(crowded, "region", "left_semi"), "large-regions")
    if not rest.head(1):
        return links
    return links.unionByName(_across(rest, odd.join(crowded, "region", "left_semi"), sets, percent))


def _versions(usable: DataFrame) -> DataFrame:
    """Links between the classes of one id."""
    seen = usable.select("doc_id", "code").distinct()
    least = seen.groupBy("doc_id").agg(F.min("code").alias("a"), F.max("code").alias("z")).filter("a < z")
    return seen.join(least, "doc_id").filter("code <> a").select("a", F.col("code").alias("b"))


def _components(docs: DataFrame, percent: int, crowded: int, turns: int, versions: bool) -> tuple[DataFrame, DataFrame]:
    """The sketches, and (code, doc_id, component) of the classes; ``versions``: those of one id are linked."""
    sketches = stored(_sketches(docs), "sketches")
    usable = sketches.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = stored(
        usable.groupBy("code").agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n").alias("n"),
            F.first("signatures").alias("signatures"),
        ),
        "classes",
    )
    orders = _orders(classes)
    met = stored(_neighbours(orders), "neighbours")
    wanted = met.select(F.col("a").alias("code")).unionByName(met.select(F.col("b").alias("code"))).distinct()
    sets = stored(_class_sets(docs, classes, wanted), "shingle-sets")
    sizes = classes.select("code", "n")
    pairs = _candidates(met).join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b")
    links = _confirmed(stored(pairs.filter(_similar("n_a", "n_b", percent)).select("a", "b"), "pairs"), sets, percent)
    if versions:
        links = links.unionByName(_versions(usable))
    found = stored(components(links), "parts")
    members = stored(_regions(orders, met, found, crowded), "forest")
    for turn in range(turns + 1):
        placed = stored(_placed(members, found), "placed")
        odd = stored(_far_from_pivot(placed, turn), "odd")
        if not odd.head(1):
            break
        if turn == turns:
            found = _merged(found, _links(placed, odd, sets, percent))
            break
        close = odd.filter(_similar("n", "pivot_n", percent)).select(*_ordered("code", "pivot")).distinct()
        found = _merged(found, _confirmed(stored(close, "more-pairs"), sets, percent))

    of_class = classes.select("code", "doc_id").join(found.withColumnRenamed("node", "code"), "code", "left")
    return sketches, of_class.withColumn("component", F.coalesce("component", "code"))


def near_duplicates(docs: DataFrame, *, percent: int = 85, crowded: int = 24, turns: int = 0) -> DataFrame:
    """A row per document: ``n_shingles``, ``component_id`` and ``kept``."""
    sketches, of_class = _components(docs, percent, crowded, turns, True)
    least = of_class.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    answer = of_class.join(least, "component").select("code", "component_id")
    takes_part = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    joined = sketches.withColumn("code", F.when(takes_part, F.col("code"))).join(answer, "code", "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def representatives(docs: DataFrame, *, percent: int = 85, crowded: int = 24, turns: int = 0) -> DataFrame:
    """``docs`` with one row of each group of near copies, of its smallest id; null ids stay.

    Versions of one id are judged apart: one goes only if its own text repeats another. Of rows without words one stays per id.
    """
    sketches, of_class = _components(docs, percent, crowded, turns, False)
    first = of_class.groupBy("component").agg(F.min(F.struct("doc_id", "code")).alias("first")).select("first.*")
    rows = sketches.filter("doc_id IS NOT NULL").groupBy("doc_id", "code", "text_key").agg(
        F.count("*").alias("times"), F.first("n").alias("n")
    )
    rows = stored(rows, "versions")
    # Texts of one class may differ in blanks or case: one of them stays.
    one = rows.groupBy("doc_id", "code").agg(F.min("text_key").alias("text_key"), F.first("n").alias("n"))
    kept = one.filter("n = 0").unionByName(one.filter("n > 0").join(first, ["doc_id", "code"], "left_semi"))
    judged = rows.join(kept.select("doc_id", "code", "text_key", F.lit(True).alias("kept")), ["doc_id", "code", "text_key"], "left")
    judged = stored(judged.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "times", "kept"), "judged")
    keyed = without(docs, ("_id", "_key", "_mark", "_word", "_bits")).withColumns({"_id": F.col("doc_id").cast("long"), "_key": _text_key()})
    other = judged.filter("kept IS NULL OR times > 1").select("_id", "_key")
    repeated = judged.filter("kept AND times > 1").select("_id", "_key")
    # Most texts are in no such row and stay where they are.
    keyed = _marked(keyed, ["_id", "_key"], other)
    sure, unsure = keyed.filter("NOT _mark"), keyed.filter("_mark")
    alone = unsure.join(other, ["_id", "_key"], "left_anti")
    again = unsure.join(repeated, ["_id", "_key"], "left_semi").dropDuplicates(["_id", "_key"])
    return sure.unionByName(alone).unionByName(again).drop("_id", "_key", "_mark")
