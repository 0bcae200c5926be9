"""Codes and codebooks against plain rounds over all distances."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from catalogue_enrich.llm import metric_trees
from catalogue_enrich.llm.metric_trees import Tree, assigned, compress, owned_sums

SCHEMA = "vec_id long, embedding array<double>, label string, code string, id int"


def plain(x, entries):
    distance = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    chosen = distance.argmin(axis=1)
    return chosen, distance[np.arange(len(x)), chosen]


@settings(deadline=None, max_examples=60)
@given(st.integers(0, 10_000), st.integers(1, 400), st.integers(1, 3), st.sampled_from([2, 9, 1000]))
def test_a_walk_is_exact(seed, n, width, spread):
    """Few different values make many equal points, equal entries and ties."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-spread, spread, (n, width))
    entries = rng.integers(-spread, spread, (int(rng.integers(1, 70)), width))
    tree = Tree.unpack(Tree(x).pack(), width)
    chosen, distance = plain(x, entries)
    got, error = assigned(tree, entries)
    assert (got == chosen).all() and (error == distance).all()
    sums = owned_sums(tree, entries)
    for e in range(len(entries)):
        assert (sums[e, :-1] == x[chosen == e].sum(axis=0)).all()
        assert sums[e, -1] == (chosen == e).sum()


def test_balls_hold_their_points_and_are_owned_whole():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(-9, 9, (500, 4)) + 1000 * c for c in range(8)])
    tree = Tree(x)
    assert sorted(tree.order.tolist()) == list(range(len(x)))
    for b in range(len(tree.lows)):
        inside = tree.points[tree.lows[b] : tree.highs[b]]
        assert (tree.sums[b] == inside.sum(axis=0)).all()
        far = ((inside - tree.pivots[b]) ** 2).sum(axis=1).max() ** 0.5
        assert far == pytest.approx(tree.radii[b])
    # Entries far apart own balls of hundreds of points; no leaf is looked into.
    entries = np.array([[1000 * c] * 4 for c in range(8)])
    balls, _, rows, _ = metric_trees.walk(tree, entries)
    assert len(rows) == 0 and len(balls) < 100


def want(rows, parts, entries, rounds):
    """Rows of id, vector and label, kept ones only, by id."""
    x = np.floor(256 * np.array([v for _, v, _ in rows])).astype(np.int64)
    width = x.shape[1] // parts
    cut = [x[:, p * width : (p + 1) * width] for p in range(parts)]
    books = [c[:entries].copy() for c in cut]
    for _ in range(rounds):
        for c, book in zip(cut, books, strict=True):
            chosen, _ = plain(c, book)
            for e in set(chosen.tolist()):
                own = c[chosen == e]
                book[e] = own.sum(axis=0) // len(own)
    found = [plain(c, book) for c, book in zip(cut, books, strict=True)]
    codes = ["".join(f"{f[0][i]:02x}" for f in found) for i in range(len(x))]
    errors = sum(f[1] for f in found).tolist()
    total = {}
    for (_, _, label), error in zip(rows, errors, strict=True):
        total[label] = total.get(label, 0) + error
    text = ",".join(str(v) for book in books for e in book.tolist() for v in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return sorted(
        ((i, codes[n], errors[n], total[label], digest) for n, (i, _, label) in enumerate(rows)),
        key=repr,
    )


def got(df):
    columns = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("block", [16_384, 50])
def test_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(metric_trees, "BLOCK", block)
    rng = np.random.default_rng(5)
    vectors = [list(map(float, v)) for v in np.round(rng.normal(size=(300, 8)), 2)]
    rows = [(10 * i, v, [None, "a", "hot", "hot"][i % 4]) for i, v in enumerate(vectors)]
    rows += [(5000 + i, vectors[7], "hot") for i in range(90)]  # equal vectors
    rows += [(6000, sorted(vectors[3]), "a")] * 2  # a row twice
    rows += [(None, vectors[9], None)]
    bad = [(1, None, "a"), (2, [0.5, None] * 4, "a"), (3, [float("nan")] * 8, "a")]
    bad += [(4, [float("inf")] * 8, "hot"), (5, [float("-inf")] * 8, None), (6, [], "a")]
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows + bad], SCHEMA)
    result, books = compress(df.repartition(3), parts=4, entries=20, rounds=2)
    assert got(result) == want(rows, 4, 20, 2)
    assert books.shape == (4, 20, 2)


def test_fewer_vectors_than_entries_and_none(spark):
    rows = [(3, [0.1, 0.2], "a"), (1, [0.3, -0.4], None), (2, [5.0, 6.0], None)]
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], SCHEMA)
    assert got(compress(df, parts=2)[0]) == want(sorted(rows), 2, 64, 2)
    assert got(compress(df.limit(0))[0]) == []


def test_what_cannot_be_coded(spark):
    def run(*vectors):
        df = spark.createDataFrame(
            [(i, v, None, None, None) for i, v in enumerate(vectors)], SCHEMA
        )
        compress(df, parts=2)[0].collect()

    with pytest.raises(ValueError):
        run([1.0, 2.0, 3.0])
    with pytest.raises(ValueError):
        run([1.0, 2.0], [1.0, 2.0, 3.0, 4.0])
    with pytest.raises(ValueError):
        run([1.0, 1e30])
