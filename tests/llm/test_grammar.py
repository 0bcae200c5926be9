"""Grammar-compressed ids: exact round trips, whole and in part."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from catalogue_enrich.llm import grammar
from catalogue_enrich.llm.grammar import Rules, Shard, compress, expansion_lengths
from catalogue_enrich.llm.queries import make_encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def documents_of(seed, n_docs, kinds):
    rng = np.random.default_rng(seed)
    phrase = rng.integers(0, kinds, 12)
    docs = []
    for _ in range(n_docs):
        own = rng.integers(0, kinds, int(rng.integers(1, 200)))
        for at in range(0, len(own) - 12, 25):
            own[at : at + 12] = phrase
        docs.append(own)
    docs.append(np.zeros(301, np.int64))  # one symbol, an odd number of times
    docs.append(np.full(64, kinds - 1))
    return docs


@settings(deadline=None, max_examples=40)
@given(st.integers(0, 10_000), st.integers(1, 30), st.sampled_from([2, 50, 5000]))
def test_what_was_replaced_comes_back(seed, n_docs, kinds):
    docs = documents_of(seed, n_docs, kinds)
    ids = np.concatenate(docs).astype(np.uint32)
    ends = np.cumsum([len(d) for d in docs])
    grammar.LEAST, least = 4, grammar.LEAST
    try:
        symbols, sizes, pairs, base = compress(ids, ends)
    finally:
        grammar.LEAST = least
    rules = Rules(pairs, expansion_lengths(pairs, base), base)
    assert len(symbols) < len(ids) and sizes.sum() == len(symbols)
    at = np.concatenate([[0], np.cumsum(sizes)])
    for i, doc in enumerate(docs):
        own = symbols[at[i] : at[i + 1]]
        assert (rules.expand(own) == doc).all()
        start = (seed + i) % len(doc)
        stop = start + 1 + (seed * 7 + i) % (len(doc) - start)
        assert (rules.stretch(own, start, stop) == doc[start:stop]).all()
    # A rule names only symbols that are older than its own.
    assert all(max(a, b) < base + i for i, (a, b) in enumerate(pairs.tolist()))


def test_the_most_frequent_pair_goes_first():
    ids = np.array([1, 2] * 200 + [2, 3] * 100 + [5, 6] * 70 + [7, 8] * 9, np.uint32)
    symbols, _, pairs, base = compress(ids, np.array([len(ids)]))
    # 2 stands on the right of the most frequent pair, so no pair of this round has it on the left:
    # 3, 2 is replaced though 2, 3 occurs once more.
    assert pairs[:3].tolist() == [[1, 2], [3, 2], [5, 6]]
    assert [7, 8] not in pairs.tolist()  # too rare
    assert len(symbols) < len(ids) / 2


TEXTS = [None, "", "  ", "one two three", "Straße, ÉTÉ!", "word " * 30_000, "a b c d. " * 900] + [
    f"the same template with number {i} in it, and more of the same words" for i in range(300)
]


def check(spark, df, rows, shards):
    """``rows`` are id and text in the order they must have."""
    tokenizer = Tokenizer.from_file(PATH)
    got = grammar.read_shards(shards).orderBy("start").collect()
    assert len(got) == len(rows)
    start = 0
    found = []
    for r in got:
        assert r.start == start
        start += r.n_tokens
        found.append((r.doc_id, r.n_tokens, r.ids_crc32))
    want = []
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, len(ids), zlib.crc32(ids.tobytes())))
    assert [f[0] for f in found] == [w[0] for w in want]
    assert sorted(found, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("most", [1 << 21, 700])
def test_files(spark, monkeypatch, folder, most):
    monkeypatch.setattr(grammar, "SHARD_TOKENS", most)
    rows = [(1000 - 3 * i, t) for i, t in enumerate(TEXTS)]
    rows += [(50, "copy")] * 40 + [(50, "other"), (None, "no id"), (None, None)]
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], "doc_id long, text string, id string, start int")
    shards = grammar.write_tokens(df.repartition(5), make_encoder, f"{folder}/tokens")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    check(spark, df, order, shards)
    sizes = shards.agg({"n_symbols": "sum", "n_tokens": "sum", "n_rules": "sum"}).first()
    if most > 1000:
        assert sizes["sum(n_symbols)"] < sizes["sum(n_tokens)"] / 3 and sizes["sum(n_rules)"] > 0
    # A stretch of one document, from its own symbols.
    tokenizer = Tokenizer.from_file(PATH)
    text = dict(rows)
    for r in shards.limit(3).collect():
        shard = Shard(r.path)
        for doc in {0, len(shard.doc_ids) // 2, len(shard.doc_ids) - 1}:
            if shard.doc_ids[doc] in (None, 50):
                continue
            own = text[shard.doc_ids[doc]] or ""
            ids = [*tokenizer.encode(own, add_special_tokens=False).ids, 1]
            assert shard.tokens(doc).tolist() == ids
            assert shard.tokens(doc, 2, 5).tolist() == ids[2:5]
            assert shard.tokens(doc, len(ids)).tolist() == []
        shard.close()


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert grammar.read_shards(grammar.write_tokens(df, make_encoder)).collect() == []


def test_other_files_are_refused(folder):
    with open(f"{folder}/x", "wb") as out:
        out.write(b"x" * 100)
    with pytest.raises(ValueError):
        Shard(f"{folder}/x")
