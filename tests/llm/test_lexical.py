"""Ranked search against scores of all documents."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from catalogue_enrich.llm import lexical
from catalogue_enrich.llm.lexical import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def plain(docs, items, k):
    """``(item, rank, doc, score)`` by the formula, every document for every item."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        scores = []
        for doc, c in counted:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in own
                if c[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=repr)


def corpus():
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(200)] + ["Straße", "ÉTÉ", "été", "x1", "日本"]
    weights = 1 / np.arange(1, len(words) + 1)
    texts = [
        " ".join(rng.choice(words, int(rng.integers(1, 60)), p=weights / weights.sum()))
        for _ in range(400)
    ]
    docs = [(3 * i, t) for i, t in enumerate(texts)]
    docs += [(5000 - i, texts[0]) for i in range(150)]  # copies: equal scores
    docs += [(7, texts[1]), (7, texts[1]), (None, texts[2]), (None, "W5-w6_W150\x00é")]
    docs += [(8, None), (9, ""), (10, " .,;\n"), (11, "w1 w150 " * 20_000)]
    items = [(i, " ".join(rng.choice(words, 12))) for i in range(30)]
    items += [(100, None), (101, ""), (102, "unknown terms only"), (None, "w5, W6!"), (5, texts[0])]
    items += [(103, " ".join(words)), (104, "w150"), (104, "w0 w0 w0")]
    return docs, items


def got(spark, docs, items, k):
    docs = spark.createDataFrame([(*d, 0, "clash") for d in docs], "doc_id long, text string, rank int, term string")
    items = spark.createDataFrame(items, "item_id long, text string")
    rows = search(docs.repartition(3), items, k).select("item_id", "rank", "doc_id", "score")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("k, cells, block", [(10, 1 << 20, 200_000), (1, 16, 40), (1000, 1, 100)])
def test_best_documents(spark, monkeypatch, k, cells, block):
    """Also with cells that all terms share, slices of a few documents, and queries in blocks."""
    monkeypatch.setattr(lexical, "CELLS", cells)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", block)
    monkeypatch.setattr(lexical, "SLICE_DOCS", 50 if k == 1 else 8192)
    docs, items = corpus()
    assert got(spark, docs, items, k) == plain(docs, items, k)


def test_accumulators_are_limited():
    """Few documents get an accumulator, and the best are those of all scores."""
    docs = [(i, f"common w{i % 100} " + "rare " * (i % 100 == 7)) for i in range(2000)]
    held = lexical._Slice()
    for i, t in docs:
        held.add(i, t.encode(), bytes([1]) * lexical.CELLS)
    lists = lexical.Lists(held.batch().to_pylist()[0], 2000, sum(held.lengths))
    made = []
    found, scores = lexical.limited(lists, [("rare", 4000), ("w7", 4000), ("common", 1)], 10, 0, made)
    assert made == [20] and set(found.tolist()) == set(range(7, 2000, 100))
    alone, all_scores = lexical.limited(lists, [("rare", 4000), ("w7", 4000), ("common", 1)], 2000, 0)
    assert dict(zip(alone.tolist(), all_scores.tolist())).items() >= dict(zip(found.tolist(), scores.tolist())).items()
    # What an earlier slice found keeps a list from being looked into.
    none, _ = lexical.limited(lists, [("common", 1)], 10, 10**12, made)
    assert made[-1] == 0 and len(none) == 0


def test_nothing_to_find(spark):
    docs, items = corpus()
    assert got(spark, docs[:0], items, 10) == []
    assert got(spark, docs, items[:0], 10) == []
    assert got(spark, [(1, None), (2, "")], items, 10) == []
