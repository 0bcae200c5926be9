"""Base measures against plain Python, and verdicts on planted texts."""

from __future__ import annotations

import math
import random
import re
import statistics
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st

from catalogue_enrich.llm import quality
from catalogue_enrich.llm.quality import (
    class_counts,
    divergence_quality,
    duplicate_lines,
    repeated_words,
)

WORDS = [f"{a}{b}{c}" for a in "aeio" for b in "lmnrst" for c in ("a", "en", "ing", "tion", "us")]


OFTEN = [1 / (rank + 2) for rank in range(len(WORDS))]


def prose(rng, n):
    return " ".join(rng.choices(WORDS, OFTEN, k=n)) + "."


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {
        i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)
    }
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 20 or 100 * len(covered) > 30 * len(words),
    }


@given(st.text(alphabet="ab \n\t\r\x0b\x0c\x1c\x85é😀#|", max_size=200))
def test_measures(text):
    data, want = text.encode(), base(text)
    kinds = class_counts(data)
    assert want["n_words"] == len(data.split())
    assert want["word_chars"] == int(kinds[:9].sum() - kinds[3])
    assert want["n_symbols"] == int(kinds[6])
    assert want["n_dup_lines"] == duplicate_lines(data)


@given(st.lists(st.sampled_from(["a", "b"]), max_size=80))
def test_repeats(words):
    data = [w.encode() for w in words]
    assert repeated_words(data) == base(" ".join(words))["n_repeat_words"]


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randrange(40, 200)), "en", "clash") for i in range(300)]
    planted = {
        1000: None,
        1001: "",
        1002: "one two",
        1003: "spam spam " * 300,
        1004: prose(rng, 150).upper() + "!!",
        1005: " | ".join(rng.choice(WORDS) for _ in range(150)),
        1006: " ".join(rng.choice(WORDS) + "&&&" for _ in range(150)),
        1007: prose(rng, 30_000),
        1008: " ".join(str(rng.random()) for _ in range(100)),
        1009: prose(rng, 60) + " 4111111111111111 mail me at a.b@c.example",
    }
    rows += [(i, t, "en", "clash") for i, t in planted.items()]
    rows += [(2000, prose(rng, 90), None, "clash"), (2001, prose(rng, 90), "xx", "clash")]
    rows += [(5, rows[5][1], "en", "clash")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality string")
    result, name = divergence_quality(df)
    assert name != "quality" and result.columns == [*df.columns, name]
    return rows, result.select("doc_id", "text", f"{name}.*").collect()


def test_base_of_every_text(judged):
    rows, got = judged
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id != 1007:
            want = base(r.text)
            assert {k: r[k] for k in want} == want


def test_verdicts(judged):
    kept = {r.doc_id: r.kept for r in judged[1]}
    assert [kept[i] for i in range(1000, 1010)] == [False] * 7 + [True, False, True]
    assert all(kept[i] for i in range(300))
    # Without a reference of its own a language is judged by the base rules.
    assert kept[2000] and kept[2001]
    assert {r.class_distance for r in judged[1] if r.doc_id == 2001} == {None}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    result, name = divergence_quality(df)
    assert result.select(f"{name}.*").collect() == []


KINDS = [
    ("lower", "a-z"), ("upper", "A-Z"), ("digit", "0-9"), ("space", r" \t\n\v\f\r"),
    ("point", r".,;:!?'\"()\-"), ("marked", r"#*$%&|<>"), ("control", r"\x00-\x08\x0e-\x1f\x7f"),
]


def classes_of(text):
    found = {name: len(re.findall(f"[{members}]", text)) for name, members in KINDS}
    found["wide"] = len(re.findall(r"[^\x00-\x7f]", text))
    found["symbol"] = len(text) - sum(found.values())
    return found


def letters(text):
    return re.findall(r"[a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def distance(p, q):
    """Jensen-Shannon by its definition."""
    a, b = sum(p.values()), sum(q.values())
    total = 0.0
    for key in {*p, *q}:
        x, y = p.get(key, 0) / a, q.get(key, 0) / b
        for one in (x, y):
            if one:
                total += one * math.log2(2 * one / (x + y)) / 2
    return math.sqrt(max(0.0, total))


def plain(rows):
    """Distances of each ``(id, text, language)`` by the rules, a language at a time."""
    out = {}
    for lang in {r[2] for r in rows}:
        texts = {i: t for i, t, own in rows if own == lang and t}
        words = Counter(w for t in texts.values() for w in letters(t))
        n = sum(words.values())
        long = [classes_of(t) for t in texts.values() if len(letters(t)) >= 30]
        common = {w: c for w, c in words.items() if 256 * c >= n}
        reference = {
            k: statistics.median(c[k] * 2000 // sum(c.values()) for c in long) for k in classes_of("")
        }
        for i, text in texts.items():
            if len(text.split()) >= 30:
                own = Counter(w if w in common else "" for w in letters(text))
                all_words = {**common, "": n - sum(common.values())}
                out[i] = (distance(classes_of(text), reference), distance(own, all_words) if own else None)
    return out


def corpus(seed=4, n_large=400, n_small=40):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randrange(35, 150)), "en") for i in range(n_large)]
    own = [f"{a}{b}" for a in ("čas", "žen", "šol", "dan") for b in ("a", "ih", "om", "Ek")]
    rows += [(5000 + i, " ".join(rng.choices(own, k=rng.randrange(35, 80))), "sl") for i in range(n_small)]
    rows += [(5990, " ".join("#$%" + str(rng.random()) for _ in range(80)), "sl")]
    rows += [(5991, prose(rng, 80), "sl"), (5992, rows[0][1], None)]
    return rows


def verdicts(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    result, name = divergence_quality(df.repartition(3))
    return {r.doc_id: r for r in result.select("doc_id", f"{name}.*").collect()}


def test_distances(spark):
    rows = corpus()
    got = verdicts(spark, rows)
    assert len(got) == len(rows)
    for i, (of_classes, of_words) in plain(rows).items():
        if i == 5992:  # a language of too few words
            assert got[i].class_distance is None
        else:
            assert got[i].class_distance == pytest.approx(of_classes, abs=1e-9)
            assert got[i].word_distance == pytest.approx(of_words, abs=1e-9)


def test_a_small_language_is_judged_as_if_alone(spark):
    """How much text of other languages there is does not matter."""
    rows = corpus(n_large=4000)
    alone = verdicts(spark, [r for r in rows if r[2] == "sl"])
    beside = verdicts(spark, rows)
    assert {i: beside[i] for i in alone} == alone
    assert not beside[5990].kept and not beside[5991].kept
    assert all(beside[5000 + i].kept for i in range(40))


def test_more_languages_than_go_to_every_task(spark, monkeypatch):
    rows = corpus()
    want = verdicts(spark, rows)
    monkeypatch.setattr(quality, "LANGUAGES", 1)
    assert verdicts(spark, rows) == want
