"""Near duplicates against all pairs, on corpora with copies of every kind."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from catalogue_enrich.llm import neardup
from catalogue_enrich.llm.neardup import forest_components, least_depth, without_near_duplicates

WORDS = [f"w{i}" for i in range(3000)]


def corpus(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(60):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(3, 200))]
        texts.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 2, 30])):
            copy = list(words)
            for _ in range(rng.randrange(0, max(2, len(words) // 12))):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            texts.append(" ".join(copy).upper() if rng.random() < 0.3 else "  ".join(copy))
    # Texts of which half is one passage that all share.
    passage = " ".join(rng.choice(WORDS) for _ in range(60))
    texts += [passage + " " + " ".join(rng.choice(WORDS) for _ in range(60)) for _ in range(80)]
    texts += ["", None, "   ", "one", "ONE", "two words", "two words", "é É"] + [texts[0]] * 40
    texts += [" ".join(rng.choice(WORDS) for _ in range(20_000))] * 2
    rows = list(enumerate(texts, 100))
    rng.shuffle(rows)
    return rows


def by_all_pairs(rows, width, percent):
    def shingles(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = lower.split()
        return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()

    sets = {key: shingles(text) for key, text in rows}
    parent = {key: key for key in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(k for k in sets if sets[k])
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            common = len(x & y)
            if 100 * common >= percent * (len(x) + len(y) - common):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {key: (len(sets[key]), root(key)) for key in sets}


@pytest.mark.parametrize("width, percent, seed", [(3, 85, 1), (5, 80, 2)])
def test_equals_all_pairs(spark, width, percent, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("set_id", F.lit("clash"))
    got = forest_components(df.repartition(5), width=width, percent=percent).collect()
    want = by_all_pairs(rows, width, percent)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_regions_larger_than_a_task(spark, monkeypatch):
    """Pages of one template share most prints, so every tree's region is large; pairs at the
    threshold must still all meet."""
    monkeypatch.setattr(neardup, "REGION", 8)
    rng, texts = random.Random(9), []
    template = [rng.choice(WORDS) for _ in range(200)]
    for _ in range(60):
        page = template + [rng.choice(WORDS) for _ in range(34)]
        texts.append(" ".join(page))
        if rng.random() < 0.7:
            for _ in range(4):
                page[rng.randrange(200, 234)] = rng.choice(WORDS)
            texts.append(" ".join(page))
    texts += [" ".join(template + [f"x{i}"]) for i in range(30)]
    rows = list(enumerate(texts, 100)) + corpus(3)[:60]
    rows = [(k if i < len(texts) else k + 10_000, t) for i, (k, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = forest_components(df.repartition(5), width=3, percent=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == by_all_pairs(rows, 3, 85)


def test_blocks_meet_once(spark, monkeypatch):
    """Every pair of rows of different labels meets in one task and in different blocks, or in a
    task of one block."""
    monkeypatch.setattr(neardup, "REGION", 8)
    rows = [(7, 0, i, "core" if i % 3 else f"own{i}") for i in range(90)]
    df = spark.createDataFrame(rows, "region long, tree int, set_id int, label string")
    tasks = defaultdict(list)
    for r in neardup.blocks(df).collect():
        tasks[r.region].append(r)
    met = Counter()
    for members in tasks.values():
        single = len({r.block for r in members}) == 1
        for a, b in combinations(sorted(members, key=lambda r: r.set_id), 2):
            met[a.set_id, b.set_id] += single or a.block != b.block
    label = {i: name for _, _, i, name in rows}
    assert all(met[a, b] == 1 for a, b in combinations(range(90), 2) if label[a] != label[b])
    assert all(not met[a, b] for a, b in combinations(range(90), 2) if label[a] == label[b] == "core")


def test_representatives(spark):
    text = " ".join(WORDS[:50])
    rows = [(3, text), (1, text), (1, text), (None, text), (5, text + " more"), (None, "else"), (9, "")]
    rows += [(10, None), (11, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash"))
    got = without_near_duplicates(df)
    assert got.columns == df.columns
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in got.where("length(text) > 1").collect())
    assert kept == [(False, 1, text), (True, 0, "else")]
    assert {r.doc_id for r in got.collect()} == {1, None, 9, 10, 11}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert forest_components(df).collect() == []
    assert without_near_duplicates(df).collect() == []


def test_least_depth():
    assert (least_depth(0.85), least_depth(0.8)) == (4, 3)
