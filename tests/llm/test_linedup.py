"""Line dedup against a plain search for runs, and on planted passages."""

from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalogue_enrich.llm.linedup import (
    align,
    common_blocks,
    decided,
    dedup_lines,
    longest_increasing,
    runs,
)

MIN = 10


@given(st.lists(st.integers(0, 20), max_size=30))
def test_longest_increasing(values):
    found = longest_increasing(values)
    picked = [values[i] for i in found]
    assert found == sorted(found) and picked == sorted(set(picked))
    best = [1] * len(values)
    for i in range(len(values)):
        best[i] = 1 + max((best[j] for j in range(i) if values[j] < values[i]), default=0)
    assert len(found) == max(best, default=0)


def longest_chain(values):
    best = [1] * len(values)
    for i in range(len(values)):
        best[i] = 1 + max((best[j] for j in range(i) if values[j] < values[i]), default=0)
    return max(best, default=0)


@given(st.permutations(range(0, 24, 2)))
def test_of_unique_lines_those_in_order_go(order):
    """Every line occurs once in both; none touches another."""
    matches = [(there, 2 * i, 2 * i + 1) for i, there in enumerate(order)]
    blocks = common_blocks(matches)
    assert len(blocks) == 12
    gone = align(matches)
    there = [order[start // 2] for start, _ in gone]
    assert all(stop == start + 1 for start, stop in gone) and there == sorted(there)
    assert len(gone) == longest_chain(order)


DOCUMENT = st.lists(st.integers(0, 5), max_size=12)


def matches_of(earlier, later):
    """Lines that both have: the n-th time here with the n-th time there, or the first."""
    out, times = [], Counter()
    for here, line in enumerate(later):
        places = [i for i, x in enumerate(earlier) if x == line]
        times[line] += 1
        if places:
            there = places[times[line] - 1] if times[line] <= len(places) else places[0]
            out.append((there, here, here + 1))
    return out


def plain_blocks(matches):
    """Common blocks, grown line by line."""
    pairs = {(there, here) for there, here, _ in matches}
    out = []
    for there, here in sorted(pairs):
        if (there - 1, here - 1) not in pairs:
            n = 1
            while (there + n, here + n) in pairs:
                n += 1
            out.append((there, here, here + n))
    return out


@given(DOCUMENT, DOCUMENT)
def test_alignment_is_a_diff(earlier, later):
    """What goes is a common subsequence that holds as many unique blocks as any order allows."""
    matches = matches_of(earlier, later)
    blocks = plain_blocks(matches)
    assert sorted(common_blocks(matches)) == sorted(blocks)
    gone = [later[i] for start, stop in align(matches) for i in range(start, stop)]
    rest = iter(earlier)
    assert all(line in rest for line in gone)
    lines = lambda first, n: set(range(first, first + n))
    unique = [
        b
        for b in blocks
        if not any(
            lines(b[1], b[2] - b[1]) & lines(c[1], c[2] - c[1])
            or lines(b[0], b[2] - b[1]) & lines(c[0], c[2] - c[1])
            for c in blocks
            if c != b
        )
    ]
    covered = {i for start, stop in align(matches) for i in range(start, stop)}
    taken = [b for b in unique if set(range(b[1], b[2])) <= covered]
    chain = longest_chain([b[0] for b in sorted(unique, key=lambda b: b[1])])
    assert len(taken) == chain
    if later == earlier:
        assert gone == later


def test_a_moved_block_goes_by_its_words_alone():
    words = np.array([20, 20, 20, 20, 60])
    moved = [[(2, 0, 2), (0, 2, 4)]]  # two blocks of 40 words that changed places
    assert len(align(moved[0])) == 1
    assert decided(moved, words, None) == align(moved[0])
    # Together they are a stretch of 80 words that an earlier document has.
    assert decided(moved, words, 50) == [(0, 4)]
    apart = [[(2, 0, 2), (0, 3, 4)]]
    assert sum(stop - start for start, stop in decided(apart, words, 50)) < 3
    assert decided([[(9, 0, 1), (0, 4, 5)]], words, 50)[-1] == (4, 5)


def test_reversed_lines_take_no_square_time():
    n = 20_000
    matches = [(2 * (n - i), 2 * i, 2 * i + 1) for i in range(n)]
    before = time.process_time()
    assert len(align(matches)) == 1
    assert time.process_time() - before < 1


def plain(rows):
    """Lines of each document that lie in a run which an earlier one has."""
    holders, out = {}, {}
    order = sorted({(k is None, k or 0, t) for k, t in rows if t})
    for doc in order:
        lines = doc[2].encode().split(b"\n")
        for run, _, _ in runs(lines, MIN):
            holders.setdefault(run, doc)
    for doc in order:
        lines = doc[2].encode().split(b"\n")
        gone = {
            i
            for run, start, stop in runs(lines, MIN)
            if holders[run] != doc
            for i in range(start, stop)
        }
        out[doc] = "\n".join(l.decode() for i, l in enumerate(lines) if i not in gone)
    return out


def test_equals_a_plain_search(spark):
    rng = random.Random(4)
    line = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    passages = ["\n".join(line(rng.randrange(2, 9)) for _ in range(4)) for _ in range(6)]
    common = line(4)
    rows = []
    for i in range(150):
        parts = [line(rng.randrange(1, 15)) for _ in range(rng.randrange(1, 12))]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        parts.insert(0, common)
        rows.append((i, "\n".join(parts)))
    rows += [(500, rows[3][1]), (501, rows[3][1]), (3, rows[3][1]), (None, rows[4][1])]
    rows += [(600, None), (601, ""), (602, "\n\n  \n"), (603, line(60_000)), (604, common)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumn("matches", F.lit("clash")).withColumn("deduped", F.lit("clash"))
    # With every stretch going wherever it stands, what goes is what any earlier document has.
    result, name = dedup_lines(df.repartition(4), min_words=MIN, moved_words=MIN)
    assert result.columns == [*df.columns, name]
    want = plain(rows)
    got = result.select("doc_id", F.col("text").alias("before"), f"{name}.*").collect()
    assert len(got) == len(rows)
    for r in got:
        if r.before:
            # Which of documents with one key comes first is a hash's say; texts differ here.
            assert r.text == want[r.doc_id is None, r.doc_id or 0, r.before], r.doc_id
        else:
            assert (r.text, r.n_deleted) == (r.before, 0)
    assert {r.doc_id: r.text for r in got}[500] == ""
    assert {r.doc_id: r.n_deleted for r in got}[604] == 0
    assert dedup_lines(df.limit(0))[0].collect() == []


@given(st.lists(st.lists(st.sampled_from([0, 1, 3, 4, 6, 7, 9, 12]), max_size=9), min_size=2, max_size=2))
def test_runs_cover_every_shared_block(documents):
    """A line of ``n`` words is the number ``n``, so documents share lines by chance."""
    earlier, later = ([b" ".join([b"%d" % n] * n) for n in lines] for lines in documents)
    want = set()
    for i in range(len(later)):
        for stop in range(i + 1, len(later) + 1):
            block = later[i:stop]
            shared = any(earlier[j : j + len(block)] == block for j in range(len(earlier)))
            if shared and block[0] and block[-1] and sum(len(x.split()) for x in block) >= MIN:
                want.update(range(i, stop))
    held = {run for run, _, _ in runs(earlier, MIN)}
    found = {i for run, start, stop in runs(later, MIN) if run in held for i in range(start, stop)}
    assert found == want


def test_a_block_goes_with_its_short_last_line(spark):
    line = lambda word, n: " ".join(f"{word}{i}" for i in range(n))
    block = line("a", 12) + "\n" + line("b", 4)
    rows = [(1, block), (2, block), (3, block + "\nown words"), (4, "own\n" + block)]
    result, name = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_words=MIN)
    assert {r.doc_id: r.text for r in result.select("doc_id", f"{name}.text").collect()} == {
        1: block, 2: "", 3: "own words", 4: "own"
    }


def test_moved_and_repeated_blocks(spark):
    line = lambda word, n: " ".join(f"{word}{i}" for i in range(n))
    a, b, c = line("a", 12), line("b", 14), line("c", 30)
    own = lambda i: f"own words of {i}"
    rows = [
        (1, "\n".join([a, own(1), b, own(11), c])),
        (2, "\n".join([b, own(2), a])),  # two short blocks that changed places: one stays
        (3, "\n".join([c, own(3), b])),  # the long one goes wherever it stands
        (4, "\n".join([a, own(4), a])),  # a repeat that the earlier document has not
        (5, "\n".join([own(50), a, own(51), a])),
        (6, "\n".join([own(50), a, own(51), a])),  # an exact copy of one that repeats
    ]
    df = spark.createDataFrame(rows + rows[-1:], "doc_id long, text string")
    result, name = dedup_lines(df, min_words=MIN, moved_words=20)
    got = {r.doc_id: r.text for r in result.select("doc_id", f"{name}.text").collect()}
    assert got[1] == rows[0][1]
    assert got[2] in ("\n".join([b, own(2)]), "\n".join([own(2), a]))
    assert got[3] == own(3)
    assert got[4] in ("\n".join([own(4), a]), "\n".join([a, own(4)]))
    assert own(50) in got[5] and got[6] == ""
