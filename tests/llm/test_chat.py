"""Chat formatting: events against a fold in Python, and exact round trips."""

from __future__ import annotations

import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalogue_enrich.llm import chat

PARTS = ["<|turn|>", "<|text|>", "<|end|>", "\\", "\\\\", "<", "|", ">", "</s>", "<s>", "[INST]"]
TEXTS = st.lists(st.sampled_from([*PARTS, "[/INST]", "<<SYS>>", "a", "\n", "é", "😀"])).map("".join)


@given(TEXTS)
def test_escapes_are_taken_back(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(p in chat.escape(text) for p in ("<|", "|>", "</s>", "<s>", "[INST]", "[/INST]"))


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|end|>"]), TEXTS)))
def test_formatted_text_tells_its_turns(turns):
    made = chat.format_messages([{"role": r, "text": t} for r, t in turns])
    assert chat.parse_formatted(made["formatted"]) == turns
    learned = [chat.unescape(made["formatted"][s["start"] : s["stop"]]) for s in made["loss"]]
    assert learned == [t for r, t in turns if r == "assistant"]


def fold(events):
    """The log of one message, event by event."""
    role, text, opened, deleted = "", "", False, False
    for _, kind, r, said in sorted(set(events), key=lambda e: (e[0], e[1], e[2] or "", e[3] or "")):
        if kind == "open" and not opened:
            role, opened = r or "", True
        elif kind == "delta":
            text += said or ""
        elif kind == "edit":
            text = said or ""
        elif kind == "regenerate":
            text = ""
        elif kind == "delete":
            deleted = True
    return None if deleted else (role, text)


def test_reconstruction_equals_a_fold(spark):
    rng = random.Random(5)
    log = []
    for conversation in (1, 2, 3, None):
        for message in range(40):
            seq = message * 100
            log.append((conversation, message, seq, "open", rng.choice(["user", "assistant", None]), None))
            for _ in range(rng.randrange(8)):
                seq += 1
                kind = rng.choice(["delta"] * 6 + ["edit", "regenerate"] + ["delete"] * (rng.random() < 0.1))
                log.append((conversation, message, seq, kind, None, rng.choice(["a", "bc", "", None, "</s>"])))
    log += rng.sample(log, 60)  # delivered twice
    rng.shuffle(log)
    events = spark.createDataFrame(
        log, "conv long, message int, seq int, kind string, role string, text string"
    ).withColumn("log", F.lit("a column of the input"))
    got = chat.reconstruct(events, "conv", ["message"], ["seq"]).collect()
    want = {}
    for conversation, message in {(e[0], e[1]) for e in log}:
        own = [e[2:] for e in log if e[:2] == (conversation, message)]
        if (folded := fold(own)) is not None:
            want[conversation, min(e[0] for e in own)] = folded
    assert {(r.conversation, r.place.seq): (r.role, r.text) for r in got} == want
    formatted = chat.render(chat.reconstruct(events, "conv", ["message"], ["seq"])).collect()
    assert len(formatted) == 4


def test_rows_of_turns(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "user", None)]
    turns += [(2, None, None, "x" * 100_000), (2, 3, "assistant", "é" * 7), (2, 3, "assistant", "é" * 7)]
    turns += [(None, 0, "assistant", "")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    log, message, sequence = chat.events_of(df.withColumn("kind", F.lit("clash")))
    messages = chat.reconstruct(log, "conversation", message, sequence)
    got = {r.conversation: r for r in chat.read_back(chat.render(messages)).collect()}
    for conversation in (1, 2, None):
        own = [t for t in turns if t[0] == conversation]
        spoken = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in own)
        learned = "".join(t or "" for _, _, r, t in own if r == "assistant")
        row = got[conversation]
        assert row.n_turns == len(own)
        assert row.turns_sha256 == hashlib.sha256(spoken.encode()).hexdigest()
        assert row.loss_chars == len(learned)
        assert row.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    empty, message, sequence = chat.events_of(df.limit(0))
    assert chat.render(chat.reconstruct(empty, "conversation", message, sequence)).collect() == []
