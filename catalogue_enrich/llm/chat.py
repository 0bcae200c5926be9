"""Chat formatting from event logs.

A conversation is stored as events: a message is opened with a role, its text arrives as streamed
deltas, an edit replaces what stood there, a regeneration discards it, a deletion drops the
message. ``reconstruct`` folds the log into final messages; ``render`` makes one string per
conversation and marks the assistant's texts as those that carry loss.

The log is partitioned by conversation and message, so a long conversation is folded by many
tasks; a fold looks for the last event that discards text and joins what follows, so it is linear
in its events. Only the finished texts of a conversation meet, in the row that holds them.

Template: ``<|turn|>role<|text|>text<|end|>`` per message. In roles and texts a backslash is put
before each backslash and into each control string (those of the template and those of common
chat formats), so no text holds one; ``unescape`` takes the backslashes out again.

Defined results: null roles and texts are empty; a null conversation is one conversation; events
equal in place, kind and text were delivered twice and count once; a message without opening
event has an empty role; messages are ordered by their first event; an empty log gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, DELTA, EDIT, REGENERATE, DELETE = "open", "delta", "edit", "regenerate", "delete"

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Where a control string is broken: after a character that one begins with or that ends a mark.
_BREAKS = re.compile(r"<(?=\||/?s>|</?SYS>)|\[(?=/?INST\])|\|(?=>)")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_MESSAGE = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.DOTALL)

RENDERED = pa.struct(
    [("formatted", pa.string())]
    + [("loss", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]
)
RENDERED_DDL = "formatted string, loss array<struct<start long, stop long>>"


def escape(text: str) -> str:
    return _BREAKS.sub(lambda m: m.group() + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def reconstruct(
    events: DataFrame,
    conversation: str,
    message: list[str],
    sequence: list[str],
    kind: str = "kind",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The final messages: ``conversation, place, role, text``; ``place`` orders them."""
    event = F.struct(
        F.struct(*sequence).alias("place"),
        F.col(kind).alias("kind"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    keys = [F.col(conversation).alias("conversation"), *[F.col(c) for c in message]]
    logs = events.groupBy(*keys).agg(
        F.array_sort(F.array_distinct(F.collect_list(event))).alias("log")
    )
    discards = F.transform(
        "log", lambda e, i: F.when(e.kind.isin(EDIT, REGENERATE), i + 1).otherwise(0)
    )
    # From the last event that discards text, or else the first.
    folded = logs.withColumn("discard", F.greatest(F.array_max(discards), F.lit(1)))
    kept = F.expr("slice(log, discard, size(log))")
    parts = F.transform(F.filter(kept, lambda e: e.kind.isin(DELTA, EDIT)), lambda e: e.text)
    opened = F.filter("log", lambda e: e.kind == OPEN)
    return folded.where(~F.exists("log", lambda e: e.kind == DELETE)).select(
        "conversation",
        F.col("log")[0].place.alias("place"),
        F.when(F.size(opened) > 0, opened[0].role).otherwise("").alias("role"),
        F.array_join(parts, "").alias("text"),
    )


def format_messages(messages: list[dict]) -> dict:
    """One conversation as a string, and the places of its assistant texts in it."""
    pieces, loss, at = [], [], 0
    for message in messages:
        head = f"{TURN}{escape(message['role'])}{TEXT}"
        text = escape(message["text"])
        if message["role"] == "assistant":
            loss.append({"start": at + len(head), "stop": at + len(head) + len(text)})
        pieces += [head, text, END]
        at += len(head) + len(text) + len(END)
    return {"formatted": "".join(pieces), "loss": loss}


def _rendered(conversations: pa.Array) -> pa.Array:
    return pa.array([format_messages(c) for c in conversations.to_pylist()], RENDERED)


def render(messages: DataFrame) -> DataFrame:
    """``conversation, formatted, loss`` from the result of ``reconstruct``."""
    ordered = F.array_sort(F.collect_list(F.struct("place", "role", "text")))
    turns = F.transform(ordered, lambda m: F.struct(m.role.alias("role"), m.text.alias("text")))
    conversations = messages.groupBy("conversation").agg(turns.alias("turns"))
    return conversations.withColumn("r", F.arrow_udf(_rendered, RENDERED_DDL)("turns")).select("conversation", "r.*")


def parse_formatted(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in _MESSAGE.findall(formatted)]


READ = pa.struct(
    [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64())]
    + [("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)
READ_DDL = (
    "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def digest(formatted: str, loss: list[dict]) -> dict:
    """What a formatted conversation says, read from the string and its loss mask alone."""
    turns = parse_formatted(formatted)
    learned = "".join(unescape(formatted[s["start"] : s["stop"]]) for s in loss)
    spoken = "".join(f"{role}\n{text}\n" for role, text in turns)
    return {
        "n_turns": len(turns),
        "turns_sha256": hashlib.sha256(spoken.encode()).hexdigest(),
        "loss_chars": len(learned),
        "loss_sha256": hashlib.sha256(learned.encode()).hexdigest(),
        "formatted_chars": len(formatted),
    }


def _read(formatted: pa.Array, loss: pa.Array) -> pa.Array:
    rows = zip(formatted.to_pylist(), loss.to_pylist(), strict=True)
    return pa.array([digest(f, spans) for f, spans in rows], READ)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation the digests of turns and of all text under the loss mask."""
    read = F.arrow_udf(_read, READ_DDL)
    rows = formatted.select("conversation", read("formatted", "loss").alias("r"))
    return rows.select("conversation", "r.*")


def events_of(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn"
) -> tuple[DataFrame, list[str], list[str]]:
    """An event log that leads to the rows of ``turns`` (columns ``role`` and ``text``), with the
    columns that tell its messages apart and those that order its events.

    Texts arrive in two deltas. Of the assistant's, every third was first another draft; of the
    others, every third was edited. Rows that agree in conversation and turn are told apart by a
    number.
    """
    row = turns.select(
        F.col(conversation).alias("conversation"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    same = Window.partitionBy("conversation", "turn").orderBy("role", "text")
    half = F.floor(F.char_length("text") / 2).cast("int")
    first = F.expr("left(text, cast(floor(char_length(text) / 2) as int))")
    second = F.substr(F.col("text"), half + 1)
    changed = F.pmod(F.xxhash64("conversation", "turn"), F.lit(3)) == 0
    assistant = F.col("role") == "assistant"

    def event(step: int, kind: str, text: Column) -> Column:
        return F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), text.alias("said"))

    events = F.array(
        event(0, OPEN, F.lit("")),
        F.when(changed, event(1, DELTA, F.reverse("text"))),
        F.when(changed & assistant, event(2, REGENERATE, F.lit(""))).when(
            changed, event(2, EDIT, first)
        ),
        F.when(~changed | assistant, event(3, DELTA, first)),
        event(4, DELTA, second),
    )
    rows = row.withColumn("copy", F.row_number().over(same)).withColumn(
        "e", F.explode(F.array_compact(events))
    )
    log = rows.select(
        "conversation", "turn", "copy", "role", "e.step", "e.kind", F.col("e.said").alias("text")
    )
    return log, ["turn", "copy"], ["turn", "copy", "step"]
