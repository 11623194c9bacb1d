"""The trie of prefixes against one built from all prefixes, and the cases its docstring defines."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest

from shelfline.llm import prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute(rows):
    own = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv_id].append(((turn is not None, turn or 0, name), role, text))
    for turns in own.values():
        turns.sort()
    built = {}
    for c in list(own):
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))  # as in SQL, the remainder has the sign of c
        built[c] = [t[1:] for t in own.get(base, [])[:h]] + [t[1:] for t in own[c][h:]]
    members, children = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[k] for k in below) if below else 1
        words = len(WORD.findall(node[-1][1])) if node else 0
        saved[node] = sum(saved[k] for k in below) + (len(members[node]) - 1) * words
    for node, held in members.items():
        ends = sorted(c for c in held if len(built[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        above = min(members[node[:-1]]) if node else None
        out.append((min(held), len(node), above, len(held), len(children[node]), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def nodes(df, **how):
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.trie(df, **how).collect()), key=repr)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_trie_is_that_of_all_prefixes(spark, partitions):
    draw = random.Random(partitions)
    rows = []
    for c in range(400):
        # Few different turns: many shared prefixes, equal conversations and conversations that are prefixes of others.
        for turn in range(draw.choice([0, 1, 3, 5, 6, 9])):
            rows.append((c, draw.choice([turn, turn, turn, None]), draw.choice("ua"), draw.choice(["x y", "z", None])))
    rows += [(None, 1, "u", "lost"), (7, 2, "u", "z"), (7, 2, "u", "z"), (-3, 0, "u", "x y")]
    rows += [(20_000 + i, t, "u", "same passage of words") for i in range(200) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert nodes(df.repartition(6), partitions=partitions) == brute(rows)


def test_long_conversations_that_branch_everywhere(spark):
    rows = [(1000 * c, t, "u", f"turn {t}" if t < 300 - c else f"own {c} {t}") for c in range(1, 60) for t in range(300)]
    assert nodes(spark.createDataFrame(rows, SCHEMA), partitions=7) == brute(rows)


def test_a_long_text_and_columns_that_clash(spark):
    rows = [(c, 0, "user", "word " * 100_000) for c in (1, 2)] + [(3, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS keys", "2 AS words", "'x' AS depth", "3 AS chain")
    assert nodes(df) == brute(rows)


def test_trie_of_an_empty_table(spark):
    assert nodes(spark.createDataFrame([], SCHEMA)) == []
    assert nodes(spark.createDataFrame([(None, 1, "u", "x")], SCHEMA)) == []
