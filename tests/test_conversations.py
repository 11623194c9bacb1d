"""Conversation jobs against plain Python on small fixtures, one conversation holding most turns."""

import json
import random

import pytest
from pyspark.sql import functions as F

from shelfline.plans import conversations as conv

HOT_TURNS = 1000


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [(1, t, rng.choice(["user", "assistant"]), f"hot {t} " + "x" * rng.randint(0, 90)) for t in range(HOT_TURNS)]
    out += [
        (2, 0, "system", "be kind"),
        (2, 1, "user", "hello there"),
        (2, 2, "assistant", "hi"),
        (3, 4, "user", "only one"),
        (4, 0, "assistant", "no question here"),
        (4, 1, "assistant", "still none"),
        (5, 255, "user", "at the edge"),
        (5, 256, "user", "of a part"),
    ]
    rng.shuffle(out)
    return out


@pytest.fixture
def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, content string").repartition(5)


def by_session(rows):
    sessions = {}
    for conv_id, turn, role, content in sorted(rows):
        sessions.setdefault(conv_id, []).append((turn, role, content))
    return sessions


def prompt_of(messages):
    if len(messages) == 1:
        return messages[0][2]
    text = conv.HISTORY_HEADER + "\n"
    for _, role, content in messages[:-1]:
        text += ("User: " if role == "user" else "Assistant: ") + content + "\n"
    return text + "\n" + conv.FOLLOW_UP_PREFIX + messages[-1][2]


def test_messages_in_order(turns, rows):
    assert [tuple(r) for r in conv.session_messages(turns).collect()] == sorted(rows)
    assert [r.turn for r in conv.session_messages(turns, 2).collect()] == [0, 1, 2]


def test_prompts_join_to_the_whole_session(turns, rows):
    parts = conv.packed_prompts(turns).orderBy("conv_id", "part").collect()
    got = {}
    for part in parts:
        got.setdefault(part.conv_id, []).append(part.prompt)
    want = {c: prompt_of(m) for c, m in by_session(rows).items()}
    assert {c: "\n".join(p) for c, p in got.items()} == want
    assert len(got[1]) == 4 and len(got[2]) == 1


def test_no_group_holds_more_than_a_part(turns):
    gathered = turns.groupBy("conv_id", F.expr("turn div 256")).count().agg(F.max("count")).head()[0]
    assert gathered <= conv.TURNS_PER_PART


def test_index(turns, rows):
    got = {r.conv_id: r for r in conv.session_index(turns).collect()}
    for conv_id, messages in by_session(rows).items():
        first = next((c for _, role, c in messages if role == "user"), conv.DEFAULT_TITLE)
        title = first[:80] + ("..." if len(first) > 80 else "")
        assert (got[conv_id].title, got[conv_id].created_at) == (title, messages[0][0])
    assert got[4].title == "New conversation"


def test_list_is_newest_first_and_never_updated_last(spark):
    index = spark.createDataFrame(
        [(1, "a", 0, 5), (2, "b", 0, None), (3, "c", 0, 9)], "conv_id int, title string, created_at int, updated_at int"
    )
    assert [r.conv_id for r in conv.session_list(index).collect()] == [3, 1, 2]


def test_delete(spark, turns):
    gone = spark.createDataFrame([(1,), (1,), (99,)], "conv_id bigint")
    assert {r.conv_id for r in conv.without_messages(turns, gone).collect()} == {2, 3, 4, 5}
    assert conv.without_sessions(conv.session_index(turns), gone).count() == 4


def test_append(spark, turns, rows):
    exchanges = spark.createDataFrame(
        [(2, 0, "q1", "a1"), (2, 1, "q2", "a2"), (77, 0, "new", "yes")],
        "conv_id bigint, number bigint, question string, answer string",
    )
    after = by_session([tuple(r) for r in conv.append_exchanges(turns, exchanges).collect()])
    assert after[2][3:] == [(3, "user", "q1"), (4, "assistant", "a1"), (5, "user", "q2"), (6, "assistant", "a2")]
    assert after[77] == [(0, "user", "new"), (1, "assistant", "yes")]
    assert len(after[1]) == HOT_TURNS


RESPONSES = {
    "last of two": ({"messages": [{"type": "ai", "content": "one"}, {"type": "ai", "content": "two"}]}, "two"),
    "empty last": ({"messages": [{"type": "ai", "content": "one"}, {"type": "ai", "content": ""}]}, "one"),
    "only human": ({"messages": [{"type": "human", "content": "one"}]}, conv.NO_ANSWER),
    "choices": ({"choices": [{"message": {"content": ""}}, {"message": {"content": "b"}}]}, "b"),
    "both": ({"messages": [{"type": "ai"}], "choices": [{"message": {"content": "c"}}]}, "c"),
    "extra fields": ({"id": 1, "messages": [{"type": "ai", "content": "x", "name": None, "tool": {}}]}, "x"),
    "structured": ({"messages": [{"type": "ai", "content": [1, 2]}]}, "[1,2]"),
    "empty object": ({}, conv.NO_ANSWER),
}


@pytest.mark.parametrize("name", list(RESPONSES))
def test_answer(spark, name):
    response, answer = RESPONSES[name]
    row = spark.createDataFrame([(json.dumps(response),)], "r string")
    assert row.select(conv.response_answer(F.col("r"))).head()[0] == answer


@pytest.mark.parametrize("text", ["", "{broken", "[]", None])
def test_unreadable_response(spark, text):
    row = spark.createDataFrame([(text,)], "r string")
    assert row.select(conv.response_answer(F.col("r"))).head()[0] == conv.NO_ANSWER
