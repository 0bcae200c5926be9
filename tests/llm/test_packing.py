"""Packing: every id once, in order, in pieces of powers of two."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from catalogue_enrich.llm import packing
from catalogue_enrich.llm.packing import numbered, pack, piece_lengths, word_ids, write_buckets
from catalogue_enrich.llm.queries import make_encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
word_ids(PATH)  # loaded once, so that no example's time holds it
ODD = [
    "", "   ", "Hello, World! don't DON'T 's", "ÉCOLÉ! Straße ﬁne é é.", "Σίσυφος ΟΔΥΣΣΕΥΣ.",
    "a\x1cb c\x85d e", "x²³5٣ ½", "​.", "İstanbul K", "日本語。", "ab.cd,,!", "a\x00b", "µª º",
    "<|ENDOFTEXT|> x <|endoftext|>a",
]


@given(st.integers(1, 100_000), st.sampled_from([1, 2, 64, 2048]))
def test_lengths(n, most):
    lengths = piece_lengths(n, most)
    assert sum(lengths) == n and max(lengths) <= most
    rest = lengths[n // most :]
    assert rest == sorted(set(rest), reverse=True)
    assert all(k & (k - 1) == 0 for k in lengths)


@given(st.lists(st.text(), max_size=4))
def test_words_give_the_ids_of_the_text(texts):
    got = word_ids(PATH)([t.encode("utf-8", "replace") for t in [*texts, *ODD]])
    want = TOKENIZER.encode_batch(
        [t.encode("utf-8", "replace").decode() for t in [*texts, *ODD]], add_special_tokens=False
    )
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [w.ids for w in want]


def test_what_is_rare_is_not_kept(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 100)
    encode = packing.WordIds(PATH)
    words = [f"w{a}{b}" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"]
    texts = [" ".join(f"often {w} Often, {w.upper()}!" for w in words)] * 2
    got = encode([t.encode() for t in texts])
    want = TOKENIZER.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [w.ids for w in want]
    assert len(encode.known) + len(encode.known.before) <= 100
    assert b"often" in encode.known


def test_symbols_behind_letters_are_no_new_words(monkeypatch):
    encode = packing.WordIds(PATH)
    asked = []
    ask = encode.ask
    monkeypatch.setattr(encode, "ask", lambda words: asked.append(words) or ask(words))
    texts = [f"{w}{s}" for w in ("plain", "Höhe", "EIN") for s in ("%%%", "***", "&&&", "<|>", "#$-")]
    got = encode([t.encode() for t in texts])
    want = TOKENIZER.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [w.ids for w in want]
    assert len(asked) == 5


def test_a_word_in_other_letters_is_no_new_word(monkeypatch):
    encode = packing.WordIds(PATH, most=60)
    learned = []
    learn = encode.known.learn
    monkeypatch.setattr(encode.known, "learn", lambda word: learned.append(word) or learn(word))
    texts = ["plain PLAIN Plain pLAin höhe", "H\u0331 h\u0331 PLAIN", "<|ENDOFTEXT|> Plain <|endoftext|>"]
    texts += [f"T\u0308 t\u0308 {a}{b} {a.upper()}{b}" for a in "abcdefgh" for b in "ijklmnop"]
    got = encode([t.encode() for t in texts])
    want = TOKENIZER.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [w.ids for w in want]
    assert learned[:2] == [b"plain", "höhe".encode()]
    assert len(encode.known) + len(encode.known.before) <= 60


def test_batches_of_texts_are_small(spark, monkeypatch):
    monkeypatch.setattr(packing, "BATCH", 7)
    seen = spark.sparkContext.accumulator(0)

    def make():
        def encode(texts):
            seen.add(len(texts) > 7)
            return [b"" for _ in texts]

        return encode

    docs = spark.range(50).coalesce(1).selectExpr("id AS doc_id", "'some text' AS text")
    assert numbered(pack(docs, make)).count() == 50
    assert seen.value == 0


def test_pieces(spark, folder):
    texts = [*ODD, None, "word " * 5000, "ab cd. " * 3000]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] * 2,
                                 "doc_id long, text string, offset string")
    sequences = numbered(pack(docs.repartition(5, "doc_id"), make_encoder))
    rows = sequences.collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    places = {}
    for r in rows:
        places.setdefault(r.bucket, []).append(r.place)
    assert {b: sorted(p) for b, p in places.items()} == {b: [*range(len(p))] for b, p in places.items()}
    assert len(places[2048]) > 2 and len(places[1]) > 2
    for i, text in enumerate(texts):
        ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: (r.piece.start, r.sequence_id))
        for copy in (own[::2], own[1::2]):
            found = []
            for r in copy:
                assert (r.piece.start, r.offset, r.piece.doc_tokens) == (len(found), 0, len(ids))
                assert r.piece.length == len(r.piece.ids) // 4 <= 2048
                assert r.piece.ids_crc32 == zlib.crc32(r.piece.ids)
                found += np.frombuffer(r.piece.ids, "<u4").tolist()
            assert found == ids
    write_buckets(sequences, f"{folder}/buckets")
    buckets = spark.read.parquet(f"{folder}/buckets")
    assert buckets.where("bucket <> piece.length").count() == 0 and buckets.count() == len(rows)
    assert numbered(pack(docs.limit(0), make_encoder)).collect() == []
    with pytest.raises(ValueError):
        pack(docs, make_encoder, most=1000)
