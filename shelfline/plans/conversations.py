"""Batch jobs over a table of conversation turns (conv_id, turn, role, content).

One conversation may hold a large share of all turns, so no job gathers a whole conversation in
one task. Where turns must stand next to each other they are gathered in parts of a bounded
number of turns; the parts of a conversation are spread over the cluster.
``(conv_id, turn)`` is the key of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.scalars import shortened

# Texts that a reader of the results relies on.
DEFAULT_TITLE = "New conversation"
HISTORY_HEADER = "Here is our conversation so far:"
USER_LABEL, ASSISTANT_LABEL = "User", "Assistant"
FOLLOW_UP_PREFIX = "Now answer this follow-up question: "
NO_ANSWER = "I couldn't process that request. Please try rephrasing your question."
TITLE_LENGTH = 80

TURNS_PER_PART = 256


def session_messages(turns: DataFrame, conv_id: int | None = None) -> DataFrame:
    """Messages in order, of one session or of all; the sort is by ranges of (session, turn)."""
    if conv_id is not None:
        turns = turns.filter(F.col("conv_id") == conv_id)
    return turns.select("conv_id", "turn", "role", "content").orderBy("conv_id", "turn")


def session_index(turns: DataFrame) -> DataFrame:
    """Title and first and last turn of each session.

    The title is the first user message; it is cut before it is aggregated, so that map tasks pass
    on short texts only.
    """
    by_user = F.col("role") == "user"
    return (
        turns.withColumn("_title", shortened(F.col("content"), TITLE_LENGTH))
        .groupBy("conv_id")
        .agg(
            F.min_by(F.when(by_user, F.col("_title")), F.when(by_user, F.col("turn"))).alias("_title"),
            F.min("turn").alias("created_at"),
            F.max("turn").alias("updated_at"),
        )
        .select("conv_id", F.coalesce("_title", F.lit(DEFAULT_TITLE)).alias("title"), "created_at", "updated_at")
    )


def session_list(index: DataFrame) -> DataFrame:
    """The session index, newest first; sessions that were never updated come last."""
    return index.orderBy(F.desc_nulls_last("updated_at"), "conv_id")


def _part(column: str, size: int = TURNS_PER_PART) -> Column:
    """The part of a position; rows without one share part -1."""
    return F.coalesce(F.call_function("div", F.col(column), F.lit(size)), F.lit(-1)).cast("long").alias("part")


def _with_session_values(rows: DataFrame, position: str, values: DataFrame, how: str = "inner") -> DataFrame:
    """Rows joined with values that are known per session, without moving a session to one task.

    The values first meet the few (conv_id, part) pairs that occur, and then the rows on that pair.
    """
    pairs = rows.select("conv_id", _part(position)).distinct().join(values, "conv_id", how)
    return rows.withColumn("part", _part(position)).join(pairs, ["conv_id", "part"], how)


def without_messages(turns: DataFrame, deleted: DataFrame) -> DataFrame:
    """Messages of the sessions that are not on the delete list.

    One join on the session, so a message without a turn goes as well; adaptive execution splits a hot session.
    """
    return turns.join(deleted.select("conv_id"), "conv_id", "left_anti")


def without_sessions(index: DataFrame, deleted: DataFrame) -> DataFrame:
    """Index entries, one row per session, of the sessions that are not on the delete list."""
    return index.join(deleted, "conv_id", "left_anti")


def packed_prompts(turns: DataFrame, turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """The whole session as one prompt: its history, then its last message as the question.

    (conv_id, part, prompt): a session has one row per ``turns_per_part`` turns, nearly always a single one; its
    prompt is the rows in order of ``part``, joined by line breaks. The counts that decide where
    the header and the question go are taken per part first, without the texts, and are joined
    back on (conv_id, part), where the gathered texts already lie.
    """
    spans = turns.groupBy("conv_id", _part("turn", turns_per_part)).agg(F.max("turn").alias("_last"), F.count(F.lit(1)).alias("_n"))
    whole = spans.groupBy("conv_id").agg(
        F.min("part").alias("_first_part"), F.max("_last").alias("_last_turn"), F.sum("_n").alias("_turns")
    )
    layout = spans.select("conv_id", "part").join(whole, "conv_id")
    message = F.struct("turn", "role", F.coalesce("content", F.lit("")).alias("content"))
    gathered = turns.groupBy("conv_id", _part("turn", turns_per_part)).agg(F.sort_array(F.collect_list(message)).alias("_messages"))

    def line(message: Column) -> Column:
        label = F.when(message["role"] == "user", USER_LABEL).otherwise(ASSISTANT_LABEL)
        question = F.concat(F.lit("\n" + FOLLOW_UP_PREFIX), message["content"])
        history = F.concat(label, F.lit(": "), message["content"])
        return F.when(message["turn"] == F.col("_last_turn"), question).otherwise(history)

    lines = F.array_join(F.transform("_messages", line), "\n")
    header = F.when(F.col("part") == F.col("_first_part"), HISTORY_HEADER + "\n").otherwise("")
    alone = F.element_at("_messages", 1)["content"]
    prompt = F.when(F.col("_turns") == 1, alone).otherwise(F.concat(header, lines))
    return gathered.join(layout, ["conv_id", "part"]).select("conv_id", "part", prompt.alias("prompt"))


RESPONSE = (
    "messages array<struct<type: string, content: string>>, "
    "choices array<struct<message: struct<content: string>>>"
)


def response_answer(response: Column) -> Column:
    """The answer in a logged JSON response.

    The last assistant message with text, else the first choice with text, else a fixed apology.
    """
    parsed = F.from_json(response, RESPONSE)
    spoken = F.filter(parsed["messages"], lambda m: (m["type"] == "ai") & (m["content"] != ""))
    chosen = F.filter(parsed["choices"], lambda c: c["message"]["content"] != "")
    return F.coalesce(
        F.try_element_at(spoken, F.lit(-1))["content"],
        F.try_element_at(chosen, F.lit(1))["message"]["content"],
        F.lit(NO_ANSWER),
    )


def append_exchanges(turns: DataFrame, exchanges: DataFrame) -> DataFrame:
    """Add questions and answers to the ends of their sessions.

    ``exchanges`` is (conv_id, number, question, answer); ``number`` counts the exchanges that are
    added to a session from 0. A session that has no turns yet starts at turn 0.
    """
    ends = turns.groupBy("conv_id").agg((F.max("turn") + 1).alias("_next"))
    position = F.coalesce("_next", F.lit(0)) + 2 * F.col("number")
    question = F.struct(position.alias("turn"), F.lit("user").alias("role"), F.col("question").alias("content"))
    answer = F.struct((position + 1).alias("turn"), F.lit("assistant").alias("role"), F.col("answer").alias("content"))
    added = _with_session_values(exchanges, "number", ends, "left").select(
        "conv_id", F.inline(F.array(question, answer))
    )
    return turns.select("conv_id", "turn", "role", "content").unionByName(added)
