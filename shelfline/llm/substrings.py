"""Removal of passages that stand more than once, behind a count-min prefilter.

A window is 35 words in a row. A word goes when a window over it has a word sequence that starts anywhere else as well.

1. Every window is counted under its anchor, the run of ``ANCHOR`` words in it with the least hash. Equal windows
   have equal anchors at equal places, so an anchor stands at least as often as any of its windows: counting
   anchors overestimates windows, with a twelfth of the rows. A text that stands several times is counted once, as
   all its windows are repeated anyhow.
2. Each partition sketches its anchors: the counters it touches, twice at most each, by slices of the hash range. The
   sketches of a slice are merged into two rows of counters, and an anchor counts as estimated repeated if both its
   counters have reached two. The number of slices grows with the anchors, so a merged slice stays of one size, and
   nothing is broadcast.
3. The second pass hashes the windows of estimated anchors to 96 bits and groups them exactly: a window that starts at
   two places of the corpus is repeated. All others were counted once and cannot be. Windows travel as columns of
   bytes by slices of the hash range, with the text and place to which the answer goes.

Hot keys: a partition sends an anchor twice at most; windows that repeat within what a task holds are settled there, and one
row of each is sent on for the others, so a slice gets one row of a window from each task. The joins are plain inner or
left joins, whose large partitions adaptive execution splits.

Defined results: a null, empty or blank text has no words and nothing to remove (its kept text is empty); a text
of fewer than 35 words stays; rows that repeat a text of 35 words or more lose all of it, with equal or null ids as well; an
empty table gives an empty result; columns other than ``doc_id`` and ``text`` are left behind.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import stored
from shelfline.llm.hashing import mixed, run_hashes, sliding, word_hashes

WINDOW, ANCHOR = 35, 12
# Anchors or windows of a slice, as slices are planned, and the counters of each of its two rows.
PER_SLICE, WIDTH_BITS = 1 << 20, 22
_SPAN = WINDOW - ANCHOR + 1
# Rows that leave a Python worker at once.
_ROWS = 512


def _words_of(text: str | None) -> list[bytes]:
    # Bytes split at the very six separators.
    return text.encode("utf-8", "surrogatepass").split() if text else []


def window_anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of every window, and the anchors by their places: each place once that is an anchor of some window."""
    if len(hashes) < WINDOW:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)
    runs = run_hashes(hashes, ANCHOR)
    least = sliding(runs, _SPAN, np.minimum)
    edge = np.zeros(_SPAN - 1, dtype=np.uint64)
    over = sliding(np.concatenate([edge, least, edge]), _SPAN, np.maximum)
    # Least hashes are small; mixed once more they fall evenly into slices and counters.
    return mixed(least), mixed(runs[runs == over])


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    keys = F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), *keys)


def _anchors(keyed: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, anchors) of the texts that have a window."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), _ROWS):
                part = batch.iloc[start : start + _ROWS]
                anchors = [window_anchors(word_hashes(_words_of(text)))[1].view(np.int64) for text in part["text"]]
                yield part[["doc_id", "k1", "k2"]].assign(anchors=anchors)[[len(a) > 0 for a in anchors]]

    return keyed.mapInPandas(found, "doc_id long, k1 long, k2 long, anchors array<long>")


def _twice_at_most(values: np.ndarray) -> np.ndarray:
    """Sorted values, each twice at most."""
    values = np.sort(values)
    keep = np.ones(len(values), dtype=bool)
    keep[2:] = values[2:] != values[:-2]
    return values[keep]


def estimated(values: np.ndarray, width_bits: int = WIDTH_BITS) -> np.ndarray:
    """The distinct values whose two counters have both reached two; ``values`` are a slice's partition sketches."""
    mask, least = np.uint64((1 << width_bits) - 1), None
    for row in range(2):
        cells = ((values >> np.uint64(row * width_bits)) & mask).astype(np.int64)
        seen = np.bincount(cells, minlength=1 << width_bits)[cells]
        least = seen if least is None else np.minimum(least, seen)
    return np.unique(values[least >= 2]) if len(values) else values


def _slice_bits(rows: int, per_slice: int) -> int:
    return max(0, (max(rows, 1) - 1).bit_length() - (per_slice - 1).bit_length())


def _sketch(texts: DataFrame, per_slice: int, bits: int, width_bits: int) -> DataFrame:
    """(anchor) of those estimated repeated."""

    def partition_sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []

        def sent() -> pd.DataFrame:
            values = _twice_at_most(np.concatenate(held))
            held.clear()
            slices = (values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), dtype=np.int64)
            starts = np.flatnonzero(np.r_[True, slices[1:] != slices[:-1]])
            return pd.DataFrame({"slice": slices[starts], "values": [p.tobytes() for p in np.split(values, starts[1:])]})

        for batch in batches:
            held += [a.astype(np.int64).view(np.uint64) for a in batch["anchors"]]
            if sum(map(len, held)) >= per_slice:
                yield sent()
        if held:
            yield sent()

    def merged(part: pd.DataFrame) -> pd.DataFrame:
        values = np.concatenate([np.frombuffer(b, dtype=np.uint64) for b in part["values"]])
        return pd.DataFrame({"anchor": estimated(values, width_bits).view(np.int64)})

    sketches = texts.select("anchors").mapInPandas(partition_sketch, "slice long, values binary")
    return sketches.groupBy("slice").applyInPandas(merged, "anchor long")


def _flags(texts: DataFrame, repeated: DataFrame) -> DataFrame:
    """(uid, k1, k2, copies, first_id, flagged): texts that stand several times or have anchors estimated repeated."""
    hit = texts.select("uid", F.explode(F.array_distinct("anchors")).alias("anchor")).join(repeated, "anchor")
    by_text = hit.groupBy("uid").agg(F.collect_list("anchor").alias("flagged"))
    counted = texts.select("uid", "k1", "k2", "copies", "first_id").join(by_text, "uid", "left")
    return counted.filter("copies > 1 OR flagged IS NOT NULL")


# In place of where a window starts: it is known to be repeated. Windows that need no answer have their place inverted.
_SETTLED = np.iinfo(np.int32).min
# Texts whose answers are gathered in one task.
_PER_PART = 1 << 14


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _compressed(keyed: DataFrame) -> DataFrame:
    """The texts as compressed bytes, as they are shuffled twice."""

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [None if t is None else zlib.compress(t.encode("utf-8", "surrogatepass"), 1) for t in batch["text"]]
            yield batch[["doc_id", "k1", "k2"]].assign(packed=texts)

    return keyed.mapInPandas(packed, "doc_id long, k1 long, k2 long, packed binary")


def _unpacked(packed: bytes | None) -> list[bytes]:
    return [] if packed is None else zlib.decompress(packed).split()


class Windows:
    """Windows that must be grouped, as columns: a hash in two parts, the text and the place."""

    def __init__(self, h: np.ndarray, g: np.ndarray, u: np.ndarray, s: np.ndarray):
        self.h, self.g, self.u, self.s = h, g, u, s

    @classmethod
    def joined(cls, parts: list[Windows]) -> Windows:
        return cls(*(np.concatenate([getattr(p, c) for p in parts]) for c in "hgus"))

    def __getitem__(self, at: np.ndarray) -> Windows:
        return Windows(*(getattr(self, c)[at] for c in "hgus"))

    def __len__(self) -> int:
        return len(self.h)

    def grouped(self) -> tuple[Windows, np.ndarray, np.ndarray]:
        """Sorted by hash; where each group of equal hashes begins, and whether its window is repeated."""
        place = np.where(self.s < 0, ~self.s, self.s)
        w = self[np.lexsort((place, self.u, self.g, self.h))]
        place = np.where(w.s < 0, ~w.s, w.s)
        fresh = np.ones(len(w), dtype=bool)
        fresh[1:] = (w.h[1:] != w.h[:-1]) | (w.g[1:] != w.g[:-1])
        begins = np.flatnonzero(fresh)
        other = ~fresh
        other[1:] &= (w.u[1:] != w.u[:-1]) | (place[1:] != place[:-1])
        return w, begins, np.logical_or.reduceat(other | (w.s == _SETTLED), begins)

    def settled_here(self) -> tuple[Windows, Windows]:
        """Those that are repeated among themselves, and what other tasks must know: a row for each distinct window."""
        w, begins, repeated = self.grouped()
        sizes = np.diff(np.r_[begins, len(w)])
        known = np.repeat(repeated, sizes)
        first = w[begins]
        first.s = np.where(repeated, _SETTLED, first.s)
        return w[known], first

    def cut(self, at: np.ndarray) -> Iterator[tuple[int, Windows]]:
        """Those of each number in ``at``, by text and place, an order in which these columns compress well."""
        order = np.lexsort((self.s, self.u, at))
        w, at = self[order], at[order]
        begins = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(w) else np.empty(0, dtype=np.int64)
        for begin, end in zip(begins, np.r_[begins[1:], len(w)]):
            yield int(at[begin]), w[np.arange(begin, end)]

    def places(self) -> bytes:
        """Texts and places as compressed differences."""
        steps = (np.diff(c, prepend=c.dtype.type(0)).tobytes() for c in (self.u, self.s))
        return zlib.compress(b"".join(steps), 1)


def _places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = zlib.decompress(data)
    n = len(data) // 12
    u = np.frombuffer(data, dtype=np.int64, count=n)
    return np.cumsum(u), np.cumsum(np.frombuffer(data, dtype=np.int32, offset=8 * n), dtype=np.int32)


def _read(part: pd.DataFrame) -> Windows:
    """Windows from the rows they travelled in; those that are settled have no hashes."""
    pairs = [_places(data) for data in part["places"]]
    u = np.concatenate([u for u, _ in pairs] or [np.empty(0, dtype=np.int64)])
    s = np.concatenate([s for _, s in pairs] or [np.empty(0, dtype=np.int32)])
    h, g = (np.frombuffer(b"".join(part[c]), dtype=kind) for c, kind in (("h", np.uint64), ("g", np.uint32)))
    return Windows(h, g, u, s) if len(h) else Windows(u.astype(np.uint64), u.astype(np.uint32), u, s)


_SENT = "slice long, settled boolean, h binary, g binary, places binary"


def _windows(marked: DataFrame, per_slice: int, bits: int) -> DataFrame:
    """The windows that must be grouped, by slices, and answers to those that are repeated within what a task holds."""

    def hashed(row) -> Windows:
        hashes = word_hashes(_unpacked(row.packed))
        starts = np.flatnonzero(np.isin(window_anchors(hashes)[0].view(np.int64), row.flagged)).astype(np.int32)
        h, g = (run_hashes(hashes, WINDOW, lane)[starts] for lane in (0, 1))
        u = np.full(len(starts), row.uid, dtype=np.int64)
        return Windows(h, (g >> np.uint64(32)).astype(np.uint32), u, ~starts if row.copies > 1 else starts)

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[Windows] = []

        def sent() -> Iterator[pd.DataFrame]:
            here, rest = Windows.joined(held).settled_here()
            held.clear()
            rows = [(at, True, b"", b"", w.places()) for at, w in here[here.s >= 0].cut(here.u[here.s >= 0] & ((1 << bits) - 1))]
            slices = (rest.h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(rest), dtype=np.int64)
            rows += [(at, False, w.h.tobytes(), w.g.tobytes(), w.places()) for at, w in rest.cut(slices)]
            yield pd.DataFrame(rows, columns=["slice", "settled", "h", "g", "places"])

        size = 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                held.append(hashed(row))
                size += len(held[-1])
                if size >= per_slice:
                    yield from sent()
                    size = 0
        if held:
            yield from sent()

    return marked.mapInPandas(found, _SENT)


def _repeated_starts(sent: DataFrame, parts: int) -> DataFrame:
    """(uid, starts): where repeated windows start in texts that stand once."""

    def grouped(part: pd.DataFrame) -> pd.DataFrame:
        known, others = _read(part[part["settled"]]), _read(part[~part["settled"]])
        if len(others):
            w, begins, repeated = others.grouped()
            known = Windows.joined([known, w[np.repeat(repeated, np.diff(np.r_[begins, len(w)]))]])
        known = known[known.s >= 0]
        rows = [(at, w.places()) for at, w in known.cut(known.u % parts)]
        return pd.DataFrame(rows, columns=["part", "places"])

    def by_text(part: pd.DataFrame) -> pd.DataFrame:
        pairs = [_places(data) for data in part["places"]]
        u, s = np.concatenate([u for u, _ in pairs]), np.concatenate([s for _, s in pairs])
        order = np.lexsort((s, u))
        u, s = u[order], s[order]
        begins = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
        return pd.DataFrame({"uid": u[begins], "starts": pd.Series(np.split(s, begins[1:]), dtype=object)})

    answers = sent.groupBy("slice").applyInPandas(grouped, "part long, places binary")
    return answers.groupBy("part").applyInPandas(by_text, "uid long, starts array<int>")


def covered(starts: np.ndarray, n_words: int) -> np.ndarray:
    """Which words lie under a window that starts at one of the places."""
    steps = np.zeros(n_words + 1, dtype=np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + WINDOW, -1)
    return np.cumsum(steps[:-1]) > 0


def _kept_words(marked: DataFrame, text_too: bool) -> DataFrame:
    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for packed, copies, starts in zip(batch["packed"], batch["copies"], batch["starts"]):
                left = words = _unpacked(packed)
                if copies > 1:  # only texts that have a window are counted
                    left = []
                elif starts is not None:
                    gone = covered(np.asarray(starts, dtype=np.int64), len(words))
                    left = [word for word, drop in zip(words, gone.tolist()) if not drop]
                changed = text_too and len(left) < len(words)
                text = b" ".join(left).decode("utf-8", "surrogatepass") if changed else None
                rows.append((len(words), len(words) - len(left), _sha(left), text))
            out = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "kept_text"])
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    return marked.mapInPandas(kept, schema)


def deduplicated(
    docs: DataFrame, *, with_text: bool = False, per_slice: int = PER_SLICE, width_bits: int = WIDTH_BITS
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) a row of ``docs``; ``with_text`` adds ``kept_text`` where words were removed."""
    keyed = _keyed(docs)
    texts = _anchors(keyed).groupBy("k1", "k2").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("first_id"), F.first("anchors").alias("anchors")
    )
    texts = stored(texts.withColumn("uid", F.monotonically_increasing_id()), "anchors")
    bits = _slice_bits(texts.agg(F.sum(F.size("anchors"))).first()[0] or 0, per_slice)
    flags = stored(_flags(texts, _sketch(texts, per_slice, bits, width_bits)), "flags")
    # An anchor has about a dozen windows.
    window_bits = _slice_bits(flags.agg(F.sum(_SPAN // 2 * F.size("flagged"))).first()[0] or 0, per_slice)
    # Of a text that stands several times one row is hashed, that of the least id.
    stands_for_all = (F.col("copies") == 1) | F.col("first_id").isNull() | (F.col("doc_id") == F.col("first_id"))
    marked = _compressed(keyed).join(flags.filter("flagged IS NOT NULL"), ["k1", "k2"]).filter(stands_for_all)
    sent = _windows(marked.select("packed", "uid", "copies", "flagged"), per_slice, window_bits)
    starts = _repeated_starts(sent, max(1, -(-flags.count() // _PER_PART)))
    verdicts = stored(flags.select("uid", "k1", "k2", "copies").join(starts, "uid", "left").drop("uid"), "verdicts")
    judged = _compressed(keyed).join(verdicts, ["k1", "k2"], "left").select("doc_id", "packed", "copies", "starts")
    result = _kept_words(judged, with_text)
    return result if with_text else result.drop("kept_text")
