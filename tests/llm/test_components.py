"""Components of graphs of every shape."""

from __future__ import annotations

import random

import pytest

from catalogue_enrich.llm.components import components

SHAPES = {
    "path": [(i, i + 1) for i in range(60)],
    "star": [(7, i) for i in range(100, 160)],
    "clique": [(a, b) for a in range(9) for b in range(a)],
    "zigzag": [(i, 99 - i) for i in range(50)] + [(i + 1, 99 - i) for i in range(49)],
    "loops and repeats": [(1, 1), (2, 3), (3, 2), (2, 3), (9, 9)],
    "none": [],
}
rng = random.Random(8)
SHAPES["random"] = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]


@pytest.mark.parametrize("name", SHAPES)
def test_components(spark, name):
    links = SHAPES[name]
    parent = {n: n for pair in links for n in pair if pair[0] != pair[1]}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            p, q = root(a), root(b)
            parent[max(p, q)] = min(p, q)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(tuple(r) for r in got) == sorted((n, root(n)) for n in parent)
