"""Quality rules: a document's histograms against those of its language.

Two histograms describe a text: the classes of its characters and its common words. The same
histograms over all documents of a language are the reference. A document whose Jensen-Shannon
distance (base 2, so from 0 to 1) to the reference of its language is too large is rejected.
For the classes the reference is the median share of each class, which a tenth of junk does not
move; for the words it is the sum of all counts.

A word is common if it makes up at least ``1 / COMMON`` of a language's words, so a language has
at most ``COMMON`` of them. Every language with ``reference_words`` words of its own has a
reference, whatever else the corpus holds. References are a table. Those of the ``LANGUAGES``
languages with most words go to every task, which bounds their size for any data; documents of
further languages, of which none holds more than ``1 / LANGUAGES`` of all words, are joined to
theirs.

Defined results: a null text counts as empty; no words means ``base_failed``. A null language is
a language of its own. A document of a language without reference, or shorter than
``min_words``, is judged by the base rules alone. Equal rows are judged alike. Columns of the
input are kept as they are; the verdict is one struct column, under a name not yet taken.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, once, small_batches, staged

COMMON = 256
LANGUAGES = 256
# Steps in which the share of a character class is counted.
SHARES = 2000
# Distinct words a task holds before it hands its counts on.
HELD_WORDS = 100_000
# Rows of a batch of texts.
BATCH = 1000

LOWER, UPPER, DIGIT, SPACE, POINT, SYMBOL, MARKED, CONTROL, WIDE = range(9)
_CLASSES = 9
_INSIDE = 9  # the further bytes of a character beyond ASCII


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, WIDE, np.uint8)
    kinds[:128] = SYMBOL
    kinds[:32] = CONTROL
    kinds[127] = CONTROL
    kinds[0x80:0xC0] = _INSIDE
    for kind, members in (
        (LOWER, bytes(range(0x61, 0x7B))),
        (UPPER, bytes(range(0x41, 0x5B))),
        (DIGIT, b"0123456789"),
        (SPACE, b" \t\n\x0b\x0c\r"),
        (POINT, b".,;:!?'\"()-"),
        (MARKED, b"#*$%&|<>"),
    ):
        kinds[list(members)] = kind
    return kinds


BYTE_CLASSES = _byte_classes()
# Letters in lower case, all other ASCII as a space: what words of a histogram are cut from.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

VERDICT = pa.struct(
    [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64())]
    + [("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_())]
    + [("class_distance", pa.float64()), ("word_distance", pa.float64()), ("kept", pa.bool_())]
)
VERDICT_DDL = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, class_distance double, word_distance double, kept boolean"
)


def class_counts(data: bytes) -> np.ndarray:
    """Characters per class; at ``_INSIDE`` the bytes that are no character of their own."""
    return np.bincount(BYTE_CLASSES[np.frombuffer(data, np.uint8)], minlength=_CLASSES + 1)


def histogram_words(data: bytes) -> list[bytes]:
    return data.translate(_LETTERS).split()


def repeated_words(words: list[bytes], width: int = 8) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for j in range(width):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    order = np.argsort(rolled, kind="stable")
    same = rolled[order[1:]] == rolled[order[:-1]]
    if not same.any():
        return 0
    # Windows of equal hash are compared as words.
    windows = defaultdict(list)
    for i in np.unique(np.concatenate([order[1:][same], order[:-1][same]])).tolist():
        windows[tuple(words[i : i + width])].append(i)
    covered = np.zeros(len(words), bool)
    for starts in windows.values():
        if len(starts) > 1:
            for i in starts:
                covered[i : i + width] = True
    return int(covered.sum())


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of two histograms given as counts."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(max(0.0, parts.sum() / 2)))


class Reference:
    """Histograms of one language: character classes, common words, all other words."""

    def __init__(self, classes: list[float], words: dict[str, int], n_words: int):
        self.classes = np.array(classes, np.float64)
        self.slots = {word.encode(): i for i, word in enumerate(sorted(words))}
        common = [words[word] for word in sorted(words)]
        self.words = np.array([*common, n_words - sum(common)], np.float64)

    def distances(self, classes: np.ndarray, words: list[bytes]) -> tuple[float, float | None]:
        own = np.zeros(len(self.words))
        for word, n in Counter(words).items():
            own[self.slots.get(word, -1)] += n
        return js_distance(classes[:_CLASSES], self.classes), (
            js_distance(own, self.words) if own.any() and self.words.any() else None
        )


def _count(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Rows of language, kind (``w`` word, ``n`` all words, ``c`` class), key and number.

    The key of a class row is ``class:share``, its number that of documents with that share.
    """
    words, others = defaultdict(Counter), Counter()

    def rows(counts: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*counts, strict=True))
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["lang", "kind", "key", "n"],
        )

    def held() -> Iterator[pa.RecordBatch]:
        for lang, counts in words.items():
            if counts:
                yield rows([(lang, "w", w.decode("utf-8", "replace"), n) for w, n in counts.items()])
        words.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = memoryview(text.as_buffer()).tobytes() if text.is_valid else b""
            own = histogram_words(data)
            words[lang].update(own)
            others[lang, "n", ""] += len(own)
            kinds = class_counts(data)[:_CLASSES]
            if len(own) >= min_words:
                for kind, share in enumerate((kinds * SHARES // kinds.sum()).tolist()):
                    others[lang, "c", f"{kind}:{share}"] += 1
            if sum(map(len, words.values())) > HELD_WORDS:
                yield from held()
    yield from held()
    if others:
        yield rows([(*key, n) for key, n in others.items()])


def references(
    documents: DataFrame, text: str, lang: str, min_words: int, reference_words: int
) -> DataFrame:
    """The reference of each language that holds enough words, from all documents: ``l`` (the
    language), ``total``, ``classes`` and ``words``."""
    counts = documents.select(F.col(lang).cast("string"), F.col(text).cast("string")).mapInArrow(
        lambda batches: _count(batches, min_words), "lang string, kind string, key string, n long"
    )
    # Batches hold whole texts.
    with small_batches(documents.sparkSession, BATCH):
        counts = staged(counts.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")), "words")
    totals = counts.where(F.col("kind") == "n").select(F.col("lang").alias("l"), F.col("n").alias("total"))
    totals = totals.where(F.col("total") >= reference_words)
    near = counts.where("kind <> 'n'").join(totals, F.col("lang").eqNullSafe(F.col("l")), "inner")
    common = near.where("kind = 'w'").where(F.col("n") * COMMON >= F.col("total"))
    words = common.groupBy("l").agg(F.map_from_entries(F.collect_list(F.struct("key", "n"))).alias("words"))
    part = [F.split_part("key", F.lit(":"), F.lit(i)).cast("int") for i in (1, 2)]
    shares = near.where("kind = 'c'").select("l", "n", part[0].alias("c"), part[1].alias("share"))
    medians = shares.groupBy("l", "c").agg(F.expr("percentile(share, 0.5, n)").alias("share"))
    classes = medians.groupBy("l").agg(
        F.map_from_entries(F.collect_list(F.struct("c", "share"))).alias("medians")
    )
    shares_of = [F.coalesce(F.element_at("medians", F.lit(c)), F.lit(0.0)) for c in range(_CLASSES)]
    key = F.struct("l").alias("key")
    found = totals.select(key, "l", "total").join(classes.select(key, F.array(*shares_of).alias("classes")), "key")
    found = found.join(words.select(key, "words"), "key", "left")
    no_words = F.create_map().cast("map<string,bigint>")
    found = found.select("l", "total", "classes", F.coalesce("words", no_words).alias("words"))
    return staged(found.where(F.exists("classes", lambda x: x > 0)), "references")


def divergence_quality(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_words: int = 30,
    max_class_distance: float = 0.15,
    max_word_distance: float = 0.65,
    slack: float = 0.6,
    reference_words: int = 1000,
    result: str = "quality",
) -> tuple[DataFrame, str]:
    """``documents`` with a struct of measures and verdict, and the name of that column.

    A document of n words, at least ``min_words``, is rejected if the distance of its character
    classes is over ``max_class_distance`` or that of its common words over ``max_word_distance``,
    each widened by ``slack / sqrt(n)``, as short texts stray further by chance; any document if it fails a base rule (fewer than 20 words, or over 30 % of its words in
    windows of eight that repeat).
    """
    found = references(documents, text, lang, min_words, reference_words)
    most = found.orderBy(F.desc("total"), F.asc_nulls_first("l")).limit(LANGUAGES)
    known = {r["l"]: Reference(r["classes"], r["words"], r["total"]) for r in most.collect()}

    def judge(data: bytes, language: str | None, own: dict | None) -> dict:
        reference = known.get(language)
        if own is not None:
            reference = Reference(own["classes"], dict(own["words"]), own["total"])
        words = data.split()
        n, kinds = len(words), class_counts(data)
        repeat = repeated_words(words)
        failed = n < 20 or 100 * repeat > 30 * n
        of_classes = of_words = None
        if n >= min_words and reference is not None:
            of_classes, of_words = reference.distances(kinds, histogram_words(data))
        return {
            "n_words": n,
            "word_chars": int(kinds[:_CLASSES].sum() - kinds[SPACE]),
            "n_symbols": int(kinds[MARKED]),
            "n_dup_lines": duplicate_lines(data),
            "n_repeat_words": repeat,
            "base_failed": failed,
            "class_distance": of_classes,
            "word_distance": of_words,
            "kept": not failed
            and (of_classes or 0.0) <= max_class_distance + slack / n**0.5
            and (of_words or 0.0) <= max_word_distance + slack / n**0.5,
        }

    @F.arrow_udf(VERDICT_DDL)
    def verdict(texts: pa.Array, langs: pa.Array, own: pa.Array) -> pa.Array:
        rows = zip(texts, langs.to_pylist(), own.to_pylist(), strict=True)
        return pa.array(
            [
                judge(memoryview(t.as_buffer()).tobytes() if t.is_valid else b"", language, reference)
                for t, language, reference in rows
            ],
            VERDICT,
        )

    name = free_name(documents, result)
    columns = (F.col(text).cast("string"), F.col(lang).cast("string"))
    none = F.lit(None).cast("struct<total: bigint, classes: array<double>, words: map<string,bigint>>")
    if len(known) < LANGUAGES:
        return documents.withColumn(name, once(verdict)(*columns, none)), name
    return _judged_by_join(documents, found, known, columns, once(verdict), name), name


def _judged_by_join(
    documents: DataFrame,
    found: DataFrame,
    known: dict[str | None, Reference],
    columns: tuple[Column, Column],
    verdict: Callable[..., Column],
    name: str,
) -> DataFrame:
    """Verdicts where some references are not ``known`` to every task.

    Documents of known languages are spread over the tasks of the join by their rows, so that no
    large language meets in one.
    """
    spark = documents.sparkSession
    key, own, is_known = (free_name(documents, c) for c in ("_key", "_own", "_known"))
    # At most LANGUAGES rows.
    names = spark.createDataFrame([(k,) for k in known], "l string")
    far = found.join(F.broadcast(names), found["l"].eqNullSafe(names["l"]), "left_anti")
    reference = F.struct("total", "classes", "words").alias(own)
    far = far.select(F.struct("l", F.lit(0).cast("bigint").alias("r")).alias(key), reference)
    marked = F.broadcast(names.select("l", F.lit(True).alias(is_known)))
    rows = documents.join(marked, columns[1].eqNullSafe(marked["l"]), "left").drop(marked["l"])
    spread = F.when(F.col(is_known), 1 + F.monotonically_increasing_id()).otherwise(0)
    rows = rows.withColumn(key, F.struct(columns[1].alias("l"), spread.cast("bigint").alias("r")))
    judged = rows.join(far, key, "left").withColumn(name, verdict(*columns, F.col(own)))
    return judged.select(*documents.columns, name)
