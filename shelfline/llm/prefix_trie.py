"""The trie of conversation prefixes, by union-find over sorted neighbours.

A conversation is the sequence of its turns, each named by a hash of role and text. All sequences are
range-partitioned and sorted, equal ones by their id. The longest common prefix (LCP) of two neighbours is the
depth at which their paths part, so a node's members are a stretch of neighbours that no shorter LCP cuts. The
edges between neighbours are taken in descending LCP, and union-find joins what they connect: a merge makes a
branching node at that depth, or adds a child to the node that is there. Between two such nodes lies a chain of
nodes with one child each, which share their members and come as one row until the end.

A node is finished when it gets a parent, unless the first or the last sequence of the stretch runs through it: the
neighbouring stretch may hold more of it. Those unfinished nodes lie along two paths. They are the contracted
forest of the stretch, again a row of items with an LCP between each two, so forests of neighbouring partitions
are merged across their borders by the same union-find, ``FAN`` at a time, until one is left. Children that are finished
before their parent and the ids that end in an unfinished node do not travel with a forest: they are written out
under the parent's name and joined with it at the end.

Conversations are rebuilt first: conversation c takes the first h turns of conversation c - c % 20 and goes on with
its own turns after its first h, h being the CRC-32 of its decimal id modulo 4; a remainder has the sign of its id.

Defined results: turns without a conv_id belong to no conversation and are left out; a null role or text counts as
empty; turns are ordered by number, null first, equal numbers by the hash that names the turn; repeated rows are turns
of their own; a rebuilt conversation without turns ends at the root; an empty table has no root and gives an
empty result; other columns are left behind. A conversation's turns meet in one row, as names and word counts: like
a text, a conversation is the unit of the work. The ids that end in one node are joined into one text, as
their digest is asked for.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import stored, word_count

# The rule by which conversations are rebuilt.
GROUP, HEADS = 20, 4
# Forests merged at a time.
FAN = 16
_KEY = 16


# Sequences


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, keys, words): the rebuilt sequences; ``keys`` joins the turns' names of 16 bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turn = F.struct(F.col("turn").cast("long"), name.alias("name"), word_count(text).alias("words"))
    slim = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), turn.alias("t"))
    whole = stored(slim.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own")), "conversations")
    heads = whole.filter(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("_base"), F.slice("own", 1, HEADS - 1).alias("head")
    )
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    based = whole.withColumns({"_base": F.col("conv_id") - F.col("conv_id") % GROUP, "h": h.cast("int")})
    nothing = F.slice("own", 1, 0)
    head = F.slice(F.coalesce("head", nothing), F.lit(1), F.col("h"))
    tail = F.slice("own", F.col("h") + 1, F.size("own") + 1)
    joined = based.join(heads, "_base", "left").select("conv_id", F.concat(head, tail).alias("s"))
    return joined.select("conv_id", F.unhex(F.array_join("s.name", "")).alias("keys"), F.col("s.words").alias("words"))


# Forests


def lcp(a: bytes, b: bytes) -> int:
    """How many turns two sequences have in common from the start."""
    n = min(len(a), len(b)) // _KEY
    if a[: n * _KEY] == b[: n * _KEY]:
        return n
    x, y = (np.frombuffer(s, dtype=np.uint64, count=2 * n).reshape(n, 2) for s in (a, b))
    return int(np.argmax((x != y).any(axis=1)))


class Node:
    """A branching or ending node; its sums are over the children that are finished.

    ``keys`` and ``words`` are those of a sequence through it. ``waiting`` holds finished chains below it that lack only the
    least id of their parent, ``ends`` the ids that end in it, ``parted`` says that some of them are written out.
    """

    __slots__ = ("depth", "keys", "words", "least", "members", "children", "leaves", "saved", "ends", "waiting", "parted")

    def __init__(self, depth: int, keys: bytes, words: list[int]):
        self.depth, self.keys, self.words = depth, keys, words
        self.least, self.members, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends: list[int] = []
        self.waiting: list[tuple] = []
        self.parted = False

    def name(self) -> bytes:
        return hashlib.md5(self.keys[: self.depth * _KEY]).digest()

    def count(self, least: int | None, members: int) -> None:
        self.members += members
        if least is not None and (self.least is None or least < self.least):
            self.least = least

    def take(self, other: Node) -> None:
        """The same node with what was seen of it further right."""
        self.count(other.least, other.members)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends += other.ends
        self.waiting += other.waiting
        self.parted |= other.parted


def leaf(conv_id: int, keys: bytes, words: list[int]) -> Node:
    node = Node(len(keys) // _KEY, keys, words)
    node.count(conv_id, 1)
    node.ends.append(conv_id)
    return node


class Rows:
    """Finished chains, names of finished parents, and ids that end in nodes that were unfinished."""

    def __init__(self) -> None:
        self.chains: list[tuple] = []
        self.names: list[tuple] = []
        self.ends: list[tuple] = []

    def part_ends(self, node: Node) -> None:
        if node.ends:
            self.ends.append((node.name(), node.ends[0], ",".join(map(str, node.ends))))
        node.ends, node.parted = [], True

    def put_off(self, node: Node) -> None:
        """Let an unfinished node travel without its finished children and ids."""
        if node.waiting:
            name = node.name()
            self.chains += [(*chain, None, name) for chain in node.waiting]
            node.waiting = []
        if node.ends:
            self.part_ends(node)

    def finish(self, node: Node, parent: Node | None, named: bool) -> None:
        """The chain from ``parent`` down to a node that has all its members; ``named``: rows refer to it by name."""
        self.chains += [(*chain, node.least, None) for chain in node.waiting]
        name = None
        if named or node.parted:
            name = node.name()
            self.names.append((name, node.least))
        if node.parted:
            self.part_ends(node)
        digest = None if node.parted else hashlib.sha256(",".join(map(str, node.ends)).encode()).hexdigest()
        leaves = node.leaves if node.children else 1
        top = parent.depth + 1 if parent else 0
        saved, sums = node.saved, []
        for words in reversed(node.words[max(top - 1, 0) : node.depth]):
            saved += (node.members - 1) * words
            sums.append(saved)
        sums = sums[::-1] or [saved]
        row = (node.least, node.members, node.children, leaves, digest, name, top, sums)
        if parent is None:
            self.chains.append((*row, None, None))
        else:
            parent.count(node.least, node.members)
            parent.children += 1
            parent.leaves += leaves
            parent.saved += sums[0]
            parent.waiting.append(row)


class Forest:
    """A stretch of the sorted row: its first and last sequence, items, and the LCP between each two items."""

    def __init__(self, first: bytes, last: bytes, items: list[tuple[Node, bool]], edges: list[int]):
        self.first, self.last, self.items, self.edges = first, last, items, edges


def merged(forests: list[Forest], rows: Rows, whole: bool = False) -> Forest:
    """Neighbouring forests as one; ``whole``: nothing lies beyond them, so that all nodes are finished.

    An item is a node and whether it was unfinished before, so that rows may refer to it by name.
    """
    items = [item for forest in forests for item in forest.items]
    edges: list[int] = []
    for at, forest in enumerate(forests):
        edges += [lcp(forests[at - 1].last, forest.first)] if at else []
        edges += forest.edges
    find = list(range(len(items)))
    tops: list[Node] = [node for node, _ in items]
    named = [name for _, name in items]
    left, right = 0, len(items) - 1  # the items whose groups touch a border
    paths: tuple[list[tuple[Node, int]], list[tuple[Node, int]]] = ([], [])

    def root(i: int) -> int:
        while find[i] != i:
            find[i] = find[find[i]]
            i = find[i]
        return i

    for edge in sorted(range(len(edges)), key=lambda e: -edges[e]):
        depth, sides = edges[edge], (root(edge), root(edge + 1))
        touch = (not whole and sides[0] == root(left), not whole and sides[1] == root(right))
        a, b = (tops[side] for side in sides)
        if a.depth == depth and b.depth == depth:
            a.take(b)
            node, name = a, named[sides[0]] or named[sides[1]]
        elif a.depth == depth or b.depth == depth:
            node, name = (a, named[sides[0]]) if a.depth == depth else (b, named[sides[1]])
        else:
            node, name = Node(depth, a.keys, a.words), False
        for side, child, path, border in zip(sides, (a, b), paths, touch):
            if child.depth > depth:
                if border:
                    path.append((child, depth))
                else:
                    rows.finish(child, node, named[side])
        find[sides[1]] = sides[0]
        tops[sides[0]], named[sides[0]] = node, name
    top, name = tops[root(0)], named[root(0)]
    first, last = forests[0].first, forests[-1].last
    if whole:
        if top.depth:
            base = Node(0, top.keys, top.words)
            rows.finish(top, base, name)
            top, name = base, False
        rows.finish(top, None, name)
        return Forest(first, last, [], [])
    kept = [node for node, _ in paths[0]], [node for node, _ in reversed(paths[1])]
    nodes = [*kept[0], top, *kept[1]]
    for node in nodes:
        rows.put_off(node)
    depths = [depth for _, depth in paths[0]] + [depth for _, depth in reversed(paths[1])]
    return Forest(first, last, [(node, True) for node in nodes], depths)


def _packed(forest: Forest) -> bytes:
    """A forest as plain values; of a path's sequence only the part down to the node is kept."""
    items = []
    for node, name in forest.items:
        values = {slot: getattr(node, slot) for slot in Node.__slots__}
        values["keys"], values["words"] = node.keys[: node.depth * _KEY], list(node.words[: node.depth])
        items.append((values, name))
    return pickle.dumps((forest.first, forest.last, items, forest.edges))


def _unpacked(data: bytes) -> Forest:
    first, last, items, edges = pickle.loads(data)
    nodes = []
    for values, name in items:
        node = Node.__new__(Node)
        for slot, value in values.items():
            setattr(node, slot, value)
        nodes.append((node, name))
    return Forest(first, last, nodes, edges)


# Partitions

_CHAIN = (
    "least long, n_convs long, n_children long, n_leaves long, ends_sha256 string, name binary, top int, "
    "saved array<long>, parent long, parent_name binary"
)
_OUT = f"chain struct<{_CHAIN.replace(' ', ':').replace(',:', ', ')}>, name binary, id long, ids string, place long, forest binary"


def _frame(rows: Rows, place: int | None = None, forest: Forest | None = None) -> pd.DataFrame:
    names = [field.split()[0] for field in _CHAIN.split(", ")]
    lines = [(dict(zip(names, chain)), None, None, None, None, None) for chain in rows.chains]
    lines += [(None, name, least, None, None, None) for name, least in rows.names]
    lines += [(None, name, first, ids, None, None) for name, first, ids in rows.ends]
    if forest is not None:
        lines.append((None, None, None, None, place, _packed(forest)))
    frame = pd.DataFrame(lines, columns=["chain", "name", "id", "ids", "place", "forest"], dtype=object)
    return frame.astype({"id": "Int64", "place": "Int64"})


def _planted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The forest of a sorted partition, and the rows that are finished within it."""
    held: list[Forest] = []
    for batch in batches:
        forests = []
        for conv_id, keys, words in zip(batch["conv_id"], batch["keys"], batch["words"]):
            forests.append(Forest(keys, keys, [(leaf(int(conv_id), keys, [int(w) for w in words]), False)], []))
        rows = Rows()
        held.append(merged(forests, rows))
        if len(held) == FAN:
            held = [merged(held, rows)]
        yield _frame(rows)
    if held:
        rows = Rows()
        forest = merged(held, rows)
        yield _frame(rows, TaskContext.get().partitionId(), forest)


def _grafted(whole: bool):
    def graft(part: pd.DataFrame) -> pd.DataFrame:
        part, rows = part.sort_values("place"), Rows()
        forest = merged([_unpacked(data) for data in part["forest"]], rows, whole)
        return _frame(rows) if whole else _frame(rows, int(part["place"].iloc[0]) // FAN, forest)

    return graft


def _rounds(sequences: DataFrame, partitions: int | None) -> list[DataFrame]:
    """What each round of merging has finished."""
    by = ["keys", "conv_id"]
    ranged = sequences.repartitionByRange(partitions, *by) if partitions else sequences.repartitionByRange(*by)
    done = [stored(ranged.sortWithinPartitions(*by).mapInPandas(_planted, _OUT), "forests")]
    while True:
        forests = done[-1].filter("forest IS NOT NULL").select("place", "forest")
        last = forests.agg(F.max("place")).first()[0]
        if last is None:
            return done
        whole = last < FAN
        groups = forests.groupBy(F.floor(F.col("place") / FAN).alias("group"))
        done.append(stored(groups.applyInPandas(_grafted(whole), _OUT), "forests"))
        if whole:
            return done


def trie(turns: DataFrame, *, partitions: int | None = None) -> DataFrame:
    """A row per node of the trie of all rebuilt conversations (conv_id, turn, role, text)."""
    rows = reduce(DataFrame.unionByName, _rounds(rebuilt(turns), partitions))
    chains = rows.filter("chain IS NOT NULL").select("chain.*")
    named = rows.filter("name IS NOT NULL AND ids IS NULL")
    parents = named.select(F.col("name").alias("parent_name"), F.col("id").alias("named_parent"))
    parts = F.array_sort(F.collect_list(F.struct("id", "ids")))
    ends = rows.filter("ids IS NOT NULL").groupBy("name").agg(parts.alias("parts"))
    ends = ends.select("name", F.sha2(F.array_join("parts.ids", ",").cast("binary"), 256).alias("named_ends"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    known = chains.join(parents, "parent_name", "left").join(ends, "name", "left")
    links = known.select("*", F.posexplode("saved").alias("step", "saved_tokens"))
    at_end = F.col("step") == F.size("saved") - 1
    depth = (F.col("top") + F.col("step")).cast("long").alias("depth")
    above = F.when(F.col("step") > 0, F.col("least")).otherwise(F.coalesce("parent", "named_parent"))
    return links.select(
        F.col("least").alias("conv_id"),
        depth,
        above.alias("parent_conv_id"),
        "n_convs",
        F.when(at_end, F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.when(at_end, F.coalesce("ends_sha256", "named_ends", nothing)).otherwise(nothing).alias("ends_sha256"),
    )
