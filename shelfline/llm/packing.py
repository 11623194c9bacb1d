"""Best-fit packing of documents into sequences, by hierarchical residual packing.

A document becomes the ids of a byte-level BPE tokenizer and a closing 0. One longer than a sequence is cut into full
pieces; its first piece takes the remainder. Pieces shorter than a sequence are packed in rounds: each task
packs its share by best fit, longest first. Bins that are nearly full are done; the others become items of the
next round, with as few tasks as hold them, until one task sees all that are left or a round no longer
merges anything. No task holds more than ``items_per_task`` items whatever the table's size, and only
lengths and numbers travel, never texts.

Defined results: a null text counts as empty, an empty text is the id 0 alone; null ids and equal rows
are documents like any other; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm.common import stored

VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
_LOOK_AHEAD = r"\s+(?!\S)|"
_SPACES = re.compile(r"\s\s")
_SWAP = sys.byteorder != "little" or array("I").itemsize != 4
_CLOSING = b"\0\0\0\0"


class Encoder:
    """Ids of whole texts as little-endian 32-bit numbers.

    Where no white space follows white space, the look-ahead of the tokenizer's cutting pattern never holds; without it
    the pattern is a plain regular expression and cutting is much faster. Texts that hold the special
    token go through the tokenizer's own file.
    """

    def __init__(self, vocabulary: str):
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        pattern = public_tokenizers.PATTERN
        self._full, self._plain = (
            tiktoken.Encoding(name, pat_str=cutting, mergeable_ranks=ranks, special_tokens={})
            for name, cutting in (("full", pattern), ("plain", pattern.replace(_LOOK_AHEAD, "")))
        )
        self._vocabulary = vocabulary

    @cached_property
    def _file(self) -> Tokenizer:
        return Tokenizer.from_file(public_tokenizers.path(f"{self._vocabulary}.json"))

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            ids = self._file.encode(text, add_special_tokens=False).ids
        elif _SPACES.search(text):
            ids = self._full.encode_ordinary(text)
        else:
            ids = self._plain.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes() if _SWAP else array("I", ids).tobytes()


@lru_cache(maxsize=1)
def encoder(vocabulary: str) -> Encoder:
    """One per Python worker."""
    return Encoder(vocabulary)


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, bytes]]:
    """(start, ids) of the pieces; all but the first are full."""
    count = len(ids) // 4
    start, end = 0, count % capacity or min(count, capacity)
    while start < count:
        yield start, ids[4 * start : 4 * end]
        start, end = end, end + capacity


def pieces_of(docs: DataFrame, capacity: int, vocabulary: str, keep_ids: bool) -> DataFrame:
    schema = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"

    def tokenized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        uid = TaskContext.get().partitionId() << 36
        for batch in batches:
            for at in range(0, len(batch), 200):
                rows = []
                part = batch.iloc[at : at + 200]
                for place, text in enumerate(part["text"]):
                    for number, (start, ids) in enumerate(cut(encode(text or "") + _CLOSING, capacity)):
                        kept = ids if keep_ids else None
                        rows.append((uid, place, number, start, len(ids) // 4, zlib.crc32(ids), kept))
                        uid += 1
                found = pd.DataFrame(rows, columns=["uid", "doc_id", "piece", "start", "length", "ids_crc32", "ids"])
                found["doc_id"] = part["doc_id"].array.take(found["doc_id"].to_numpy())
                yield found

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = texts.mapInPandas(_whole_ids(tokenized), schema)
    return found if keep_ids else found.drop("ids")


def _whole_ids(run: Callable) -> Callable:
    """Ids stay whole numbers where some are null."""

    def wrapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return run(b.assign(doc_id=b["doc_id"].astype("Int64")) for b in batches)

    return wrapped


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each item, packed in the given order, and the fill of each bin.

    ``room`` has a bit for each amount of free room that some bin has: the lowest bit from an item's length on is the
    bin that it fits best.
    """
    bins, offsets, fills = np.empty(len(lengths), "int64"), np.empty(len(lengths), "int64"), []
    room, open_bins = 0, [[] for _ in range(capacity + 1)]
    for place, length in enumerate(lengths.tolist()):
        above = room >> length
        if above:
            free = length + (above & -above).bit_length() - 1
            which = open_bins[free].pop()
            if not open_bins[free]:
                room &= ~(1 << free)
        else:
            which, free = len(fills), capacity
            fills.append(0)
        bins[place], offsets[place] = which, fills[which]
        fills[which] += length
        free -= length
        if free:
            open_bins[free].append(which)
            room |= 1 << free
    return bins, offsets, fills


def _round(items: DataFrame, capacity: int, number: int, tasks: int) -> DataFrame:
    """(uid, bin, offset, fill of the bin) of the items (uid, length)."""

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = list(batches)
        if not rows:
            return
        own = pd.concat(rows).sort_values(["length", "uid"], ascending=[False, True])
        bins, offsets, fills = best_fit(own["length"].to_numpy(), capacity)
        base = (number << 56) | (TaskContext.get().partitionId() << 32)
        yield pd.DataFrame(
            {"uid": own["uid"].to_numpy(), "bin": bins + base, "offset": offsets, "fill": np.array(fills, "int64")[bins]}
        )

    return items.repartition(tasks, F.xxhash64("uid", F.lit(number))).mapInPandas(
        packed, "uid long, bin long, offset long, fill long"
    )


def pack(
    docs: DataFrame,
    *,
    capacity: int = 2048,
    nearly_full: int = 16,
    items_per_task: int = 50_000,
    vocabulary: str = VOCABULARY,
    keep_ids: bool = False,
) -> DataFrame:
    """A row per piece with ``sequence_id`` and ``offset``; ``keep_ids`` adds the ids themselves.

    A bin with at most ``nearly_full`` free places is done.
    """
    pieces = stored(pieces_of(docs, capacity, vocabulary, keep_ids), "pieces")
    short = pieces.filter(F.col("length") < capacity)
    items, count, number, rounds = short.select("uid", "length"), short.count(), 1, []
    while count:
        tasks = -(-count // items_per_task)
        placed = stored(_round(items, capacity, number, tasks), f"packing-{number}")
        rounds.append(placed)
        left = placed.filter((F.col("offset") == 0) & (F.col("fill") < capacity - nearly_full))
        items = left.select(F.col("bin").alias("uid"), F.col("fill").alias("length"))
        before, count, number = count, items.count(), number + 1
        if tasks == 1 or count > 0.99 * before:
            break
    columns = [c for c in pieces.columns if c != "uid"]
    if not rounds:
        return pieces.select(*columns, (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    place = rounds[0].select("uid", F.col("bin").alias("sequence_id"), "offset")
    for placed in rounds[1:]:
        moved = placed.select(F.col("uid").alias("sequence_id"), "bin", F.col("offset").alias("_more"))
        place = place.join(moved, "sequence_id", "left").select(
            "uid",
            F.coalesce("bin", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("_more", F.lit(0))).alias("offset"),
        )
    return pieces.join(place, "uid", "left").select(
        *columns,
        F.coalesce("sequence_id", -F.col("uid") - 1).alias("sequence_id"),
        F.coalesce("offset", F.lit(0).cast("long")).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of packed pieces that carry their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda done, part: F.concat(done, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
