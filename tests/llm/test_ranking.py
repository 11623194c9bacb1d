"""Ranked search against a plain scan of all documents, and the cases its docstring defines."""

import collections
import math
import random
import re

import pytest

from shelfline.llm import ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top):
    counted = [(doc_id, collections.Counter(terms(text))) for doc_id, text in docs]
    counted = [(doc_id, c, sum(c.values())) for doc_id, c in counted if c]
    total, length = len(counted), sum(n for *_, n in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    found = []
    for item_id, text in items:
        scored = []
        for doc_id, c, n in counted:
            m = 75 + (25 * n * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms(text)
                if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        found += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(scored[:top], 1)]
    return found


def answers(docs, items, **how):
    rows = ranking.search(docs, items, **how).collect()
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in rows), key=str)


@pytest.mark.parametrize("width,block", [(8, 512), (64, 3), (4096, 512)])
def test_search_is_that_of_a_plain_scan(spark, documents, width, block):
    draw = random.Random(width)
    words = [f"w{i}" for i in range(60)] + ["Élan", "naïve", "X1"]
    docs = [(i, " ".join(draw.choice(words) for _ in range(draw.randrange(0, 60)))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(30)]  # ties by the dozen
    docs += [(2000, "-- !!"), (2001, None), (2002, ""), (None, docs[7][1]), (2003, "w1 " * 30_000)]
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.randrange(1, 9)))) for i in range(12)]
    items += [(50, docs[7][1]), (51, None), (52, "?!"), (53, "unheard of"), (54, "W1,w1;w1")]
    table = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    got = answers(documents(docs).repartition(5), table, width=width, block=block, batch_rows=50)
    assert got == sorted(brute(docs, items, 20), key=str)


def test_a_bound_is_never_below_the_score():
    draw = random.Random(1)
    vocabulary = [f"t{i}".encode() for i in range(300)]
    weighed = [[(t, draw.randrange(1, 9000)) for t in draw.sample(vocabulary, 20)] for _ in range(10)]
    sketcher = ranking.Sketcher(weighed, 64)
    for _ in range(50):
        counts = collections.Counter(draw.choices(vocabulary, k=80))
        bounds = sketcher.bounds(counts, 90)
        for q, query in enumerate(weighed):
            assert bounds[q] >= sum(w * ranking.impact(counts[t], 90) for t, w in query if t in counts)


def test_search_of_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert answers(documents([]), items) == []
    assert answers(documents([(1, "word")]), items.filter("item_id < 0")) == []
    assert answers(documents([(1, None), (2, " ")]), items) == []


def test_repeated_rows_of_both_sides(spark, documents):
    items = spark.createDataFrame([(1, "blue sky"), (1, "blue sky"), (1, "sky")], "item_id long, text string")
    docs = [(5, "blue sky above"), (5, "blue sky above"), (6, "grey sea"), (7, "green field")]
    got = answers(documents(docs), items)
    assert [(i, d) for i, _, d, _ in got] == [(1, 5)] * 4
    assert sorted(rank for _, rank, _, _ in got) == [1, 1, 2, 2]
