"""Removal of repeated passages against a plain count of all windows, and the cases its docstring defines."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from shelfline.llm import hashing, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    split = [(doc_id, WORD.findall(text or "")) for doc_id, text in rows]
    counts = collections.Counter(tuple(w[i : i + 35]) for _, w in split for i in range(len(w) - 34))
    out = []
    for doc_id, w in split:
        gone = set()
        for i in range(len(w) - 34):
            if counts[tuple(w[i : i + 35])] > 1:
                gone.update(range(i, i + 35))
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=repr)


def results(df, **how):
    rows = substrings.deduplicated(df, **how).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=repr)


def planted():
    draw = random.Random(9)

    def fresh(n):
        return [f"{draw.choice('abcdefg')}{draw.randrange(4000)}" for _ in range(n)]

    passages = [fresh(n) for n in (34, 35, 36, 50, 90)]
    rows = []
    for i in range(160):
        words = fresh(draw.randrange(0, 120))
        for _ in range(draw.randrange(0, 3)):
            at = draw.randrange(len(words) + 1)
            words[at:at] = draw.choice(passages)
        rows.append((i, draw.choice([" ", "\n", " \t"]).join(words)))
    near = fresh(200)
    for i in range(40):
        rows.append((1000 + i, " ".join([*near[: 5 * i], f"edit{i}", *near[5 * i :]])))
    rows += [(2000, rows[3][1]), (2000, rows[3][1]), (None, rows[4][1]), (None, " ".join(near)), (None, " ".join(near))]
    rows += [(3000, None), (3001, ""), (3002, " \n"), (3003, "few words"), (3004, "few words")]
    rows += [(4000, "again " * 34), (4001, "again and " * 18), (4002, "twice " * 36)]
    rows += [(5000, " ".join(f"long{i}" for i in range(40_000))), (5001, " ".join(f"long{i}" for i in range(20_000, 20_050)))]
    return rows


@pytest.mark.parametrize("per_slice,width_bits", [(1 << 20, 22), (500, 22), (2000, 4)])
def test_passages_are_those_of_a_plain_count(documents, per_slice, width_bits):
    """Narrow sketches overestimate nearly everything and must still lose and add nothing."""
    rows = planted()
    got = results(documents(rows).repartition(5), per_slice=per_slice, width_bits=width_bits)
    assert got == brute(rows)


def test_kept_text(documents):
    a = [f"a{i}" for i in range(60)]
    rows = [(1, " ".join(["x", *a, "y"])), (2, " ".join([*a, "z"])), (3, "alone"), (4, " ".join(a[:40])), (5, " ".join(a[:40]))]
    got = {r.doc_id: r.kept_text for r in substrings.deduplicated(documents(rows), with_text=True).collect()}
    assert got == {1: "x y", 2: "z", 3: None, 4: "", 5: ""}


def test_an_empty_table(documents):
    assert results(documents([])) == []


def test_equal_windows_have_equal_anchors_that_are_counted_as_often():
    draw = np.random.default_rng(3)
    words = draw.integers(0, 6, 4000)  # so few words that windows and anchors repeat within the text
    hashes = hashing.word_hashes([str(w).encode() for w in words])
    least, places = substrings.window_anchors(hashes)
    counted = collections.Counter(places.tolist())
    windows = collections.defaultdict(list)
    for i in range(len(words) - 34):
        windows[tuple(words[i : i + 35])].append(int(least[i]))
    for anchors in windows.values():
        assert len(set(anchors)) == 1
        assert counted[anchors[0]] >= len(anchors)


def test_anchors_fall_evenly_into_slices():
    draw = np.random.default_rng(8)
    hashes = draw.integers(0, 1 << 63, 60_000, dtype=np.uint64) * np.uint64(2)
    _, places = substrings.window_anchors(hashes)
    counts = np.bincount((places >> np.uint64(61)).astype(np.int64), minlength=8)
    assert counts.max() < 1.3 * counts.mean()


def test_estimates_are_never_too_low():
    draw = np.random.default_rng(5)
    values = draw.integers(0, 1 << 63, 3000).astype(np.uint64)
    twice = np.concatenate([values, values[:400]])
    assert set(values[:400].tolist()) <= set(substrings.estimated(twice, 10).tolist())
    assert set(substrings.estimated(twice, 22).tolist()) == set(values[:400].tolist())
