"""Ranked lexical search: term-at-a-time with a limited set of accumulators.

Documents are cut into slices, each with its own inverted lists, and a slice answers all queries
by itself: what the best documents of a corpus are is decided among the best of its slices.

For a query a slice takes the terms rarest first. A document that a list names gets an
accumulator of its partial score. Every term has a bound, the most that it adds to any document of
the slice; once the bounds of the terms that are left add up to less than the k-th best partial
score (of this slice, or final score of the slices that the task had before), a document without
an accumulator can no longer be among the best and none is created. The accumulators there are go
on to be updated, so their scores are exact.

Only terms that some query may ask for are indexed: a fixed number of cells, by a hash of the
term, tells which. A term that shares a cell with one is indexed in vain, no more. Texts are read
once; the index is written, and each block of queries (bounded by its terms) reads it.

Defined results: a null text has no terms, and neither it nor an empty one is a document that
counts. A null id is an id and comes last among equal scores; rows with one id are documents each
by itself. Queries with one id, null included, are one query; a query without terms, or with no
document, has no rows. Columns other than id and text do not matter, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, staged

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bytes as terms know them: capitals are small, other ASCII but digits and letters parts terms.
_FOLD = bytes(
    b if b > 0x7F else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256)
)

CELLS = 1 << 20  # that terms of queries are noted in
SLICE_DOCS = 8192
SLICE_POSTINGS = 4_000_000
BLOCK_TERMS = 200_000  # of the queries that are searched for together

SLICE = (
    "ids array<long>, lengths binary, terms array<string>, holders array<long>, docs binary, "
    "counts binary, n_docs long, n_terms long"
)


def terms_of(text: Column) -> Column:
    """The distinct terms of a text, as an array."""
    return F.array_distinct(
        F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))
    )


def _cells(terms: DataFrame) -> bytes:
    """A byte per cell: whether a term of a query falls into it."""
    cell = F.pmod(F.crc32(F.encode("term", "UTF-8")), F.lit(CELLS)).alias("cell")
    asked = np.zeros(CELLS, np.uint8)
    asked[[r["cell"] for r in terms.select(cell).distinct().collect()]] = 1
    return asked.tobytes()


class _Slice:
    """Documents and their postings, until they are written."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.numbers: dict[bytes, int] = {}
        self.terms: list[int] = []
        self.sizes: list[int] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, text: bytes, asked: bytes) -> None:
        words = text.translate(_FOLD).split()
        if not words:
            return
        found = Counter(words)
        own = [t for t in found if asked[zlib.crc32(t) % CELLS]]
        number = self.numbers
        self.terms += [number.setdefault(t, len(number)) for t in own]
        self.counts += [found[t] for t in own]
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.sizes.append(len(own))

    def is_full(self) -> bool:
        return len(self.ids) >= SLICE_DOCS or len(self.terms) >= SLICE_POSTINGS

    def batch(self) -> pa.RecordBatch:
        terms = np.array(self.terms, np.int64)
        order = np.argsort(terms, kind="stable")
        docs = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.sizes)[order]
        values = [
            self.ids,
            np.array(self.lengths, np.int64).tobytes(),
            [t.decode() for t in self.numbers],
            np.bincount(terms, minlength=len(self.numbers)).tolist(),
            docs.tobytes(),
            np.array(self.counts, np.int64)[order].tobytes(),
            len(self.ids),
            sum(self.lengths),
        ]
        longs, texts = pa.list_(pa.int64()), pa.list_(pa.string())
        kinds = [longs, pa.binary(), texts, longs, pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        names = [c.split()[0] for c in SLICE.split(", ")]
        arrays = [pa.array([v], k) for v, k in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)


def index(documents: DataFrame, asked: bytes) -> DataFrame:
    """Slices of ``documents`` (``id, text``) with the postings of the terms that are ``asked``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Slice()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, text in zip(ids, batch.column(1), strict=True):
                if text.is_valid:
                    held.add(doc_id, memoryview(text.as_buffer()).tobytes(), asked)
                    if held.is_full():
                        yield held.batch()
                        held = _Slice()
        if held.ids:
            yield held.batch()

    return documents.mapInArrow(cut, SLICE)


class Lists:
    """The inverted lists of a slice, with what a posting is worth before its term's weight."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.ids: list[int | None] = row["ids"]
        lengths = np.frombuffer(row["lengths"], np.int64)
        if int(lengths.max()) * 90 * n_docs < 1 << 62:
            norm = 10 + 90 * lengths * n_docs // n_terms
        else:
            norm = np.array([10 + 90 * n * n_docs // n_terms for n in lengths.tolist()])
        self.docs = np.frombuffer(row["docs"], np.int32)
        counts = np.frombuffer(row["counts"], np.int64)
        self.worth = 1_000_000_000 * counts // (1000 * counts + 8 * norm[self.docs])
        self.ends = np.cumsum(row["holders"])
        self.at = {term: i for i, term in enumerate(row["terms"])}
        # Every term that is indexed has a posting.
        starts = self.ends - np.array(row["holders"])
        self.most = np.maximum.reduceat(self.worth, starts) if len(starts) else starts
        self.starts = starts

    def get(self, term: str) -> tuple[np.ndarray, np.ndarray, int] | None:
        """Documents, worths and the greatest worth of a term."""
        i = self.at.get(term)
        if i is None:
            return None
        here = slice(self.starts[i], self.ends[i])
        return self.docs[here], self.worth[here], int(self.most[i])


def _kth(scores: np.ndarray, k: int) -> int:
    """The k-th greatest score, 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[-k]) if len(scores) >= k else 0


def limited(
    lists: Lists, terms: list[tuple[str, int]], k: int, least: int, made: list[int] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a slice that may be among the ``k`` best, and their scores.

    ``terms`` (term, weight) come rarest first. Scores below ``least`` are of no use to the
    caller. ``made`` is told the number of accumulators.
    """
    found = [(*entry, weight) for t, weight in terms if (entry := lists.get(t)) is not None]
    left = sum(most * weight for _, _, most, weight in found)
    score = np.zeros(len(lists.ids), np.int64)
    has = np.zeros(len(lists.ids), bool)
    floor, creating = least, True
    for docs, worth, most, weight in found:
        if creating and left < floor:
            creating = False
            if not has.any():
                break
        if creating:
            score[docs] += worth * weight
            has[docs] = True
            floor = max(floor, _kth(score, k))
        else:
            there = has[docs]
            score[docs[there]] += worth[there] * weight
        left -= most * weight
    if made is not None:
        made.append(int(has.sum()))
    best = np.flatnonzero(score >= max(1, least, _kth(score, k)))
    return best, score[best]


def _best(found: list[tuple[int, int | None]], k: int) -> list[tuple[int, int | None]]:
    """The ``k`` greatest scores with their ids, ties to the smaller id, null last."""
    return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))[:k]


Queries = dict[int | None, list[tuple[str, int]]]
HITS = "item_id long, doc_id long, score long"


def _search(slices: DataFrame, queries: Queries, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The best ``k`` documents that each task has of every query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int | None, list[tuple[int, int | None]]] = {item: [] for item in queries}
        for batch in batches:
            for row in batch.to_pylist():
                lists = Lists(row, n_docs, n_terms)
                for item, terms in queries.items():
                    held = best[item]
                    docs, scores = limited(lists, terms, k, held[-1][0] if len(held) == k else 0)
                    ids = [lists.ids[d] for d in docs.tolist()]
                    best[item] = _best([*held, *zip(scores.tolist(), ids, strict=True)], k)
        rows = [(item, doc, score) for item, own in best.items() for score, doc in own]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        names = [c.split()[0] for c in HITS.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return slices.mapInArrow(run, HITS)


def search(
    documents: DataFrame,
    queries: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of every query.

    With N documents that have terms, L terms in all, n of a document, df documents that hold a
    term and tf times in one, a term adds ``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` where
    ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and ``m = 10 + (90 * n * N) div L``.
    Ids are long.
    """
    asked = staged(
        queries.select(
            F.col(item_id).cast("long").alias("item_id"), F.explode(terms_of(F.col(text))).alias("term")
        ).distinct(),
        "terms",
    )
    texts = documents.select(
        F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")
    )
    # Batches hold whole texts, slices whole lists.
    with small_batches(documents.sparkSession, 500):
        slices = staged(index(texts, _cells(asked)), "slices")
    with small_batches(documents.sparkSession, 1):
        return _ranked(slices, asked, k)


def _ranked(slices: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    n_docs, n_terms = slices.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    held = slices.select(F.inline(F.arrays_zip("terms", "holders"))).groupBy("terms")
    held = held.agg(F.sum("holders").alias("df")).withColumnRenamed("terms", "term")
    n = F.lit(n_docs or 0)
    weight = F.floor(1000 * F.log((2 * n + 2) / (2 * F.col("df") + 1))).cast("long")
    # A term that weighs nothing adds nothing.
    weighed = asked.join(held, "term").select("item_id", "term", "df", weight.alias("weight"))
    weighed = staged(weighed.where("weight > 0"), "weights")
    blocks = -(-weighed.count() // BLOCK_TERMS)
    hits = slices.sparkSession.createDataFrame([], HITS)
    for block in range(blocks):
        own: dict[int | None, list[tuple[int, str, int]]] = {}
        here = F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block
        for r in weighed.where(here).collect():
            own.setdefault(r["item_id"], []).append((r["df"], r["term"], r["weight"]))
        queries = {item: [(t, w) for _, t, w in sorted(terms)] for item, terms in own.items()}
        hits = hits.union(staged(_search(slices, queries, n_docs, n_terms, k), "hits"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
