"""Packing: documents cut into pieces whose lengths are powers of two.

A document of n tokens becomes as many pieces of the full sequence length as fit, and one piece
for each binary digit of the rest. Every piece is a sequence of its own: no sequence holds tokens
of two documents, none is padded, and sequences of one length (``bucket``) fill a batch evenly.
Cutting needs no other document: texts and ids are never shuffled. ``pack`` counts the sequences
of each length within a task, and ``numbered`` adds what the tasks before it have of that length,
so a bucket's sequences have the places 0, 1, 2 and so on. ``write_buckets`` puts each length into
a folder of its own.

Defined results: a null text is empty, and an empty document is its end token alone; repeated
rows are packed each by itself, in any order; a very long text is cut by one task; an empty table
has no sequences; columns of the input that are named like a result are dropped.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, staged

PIECE = pa.struct(
    [("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64())]
    + [("ids_crc32", pa.int64()), ("ids", pa.binary())]
)
PIECE_DDL = "start long, length long, doc_tokens long, ids_crc32 long, ids binary"
RESULT = {"piece", "bucket", "task", "nth", "place", "sequence_id", "offset"}
# Words and their ids that a task keeps, at about 150 bytes each.
CACHED_WORDS = 400_000
# Rows of a batch of texts or pieces.
BATCH = 1000
_MARKS = b".,;:!?#*$%&|<>()\"-"
# Byte-level vocabularies write a byte that prints as its character, the others, in order, as
# those from U+0100 on.
_PRINTS = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = {b: chr(0x100 + i) for i, b in enumerate(b for b in range(0x100) if b not in _PRINTS)}
# Of the letters up to U+00FF.
_SYMBOLS = {i: "".join(_OTHERS.get(b, chr(b)) for b in chr(i).encode()) for i in range(0x100)}


def piece_lengths(n: int, most: int) -> list[int]:
    """``n`` as full pieces and, falling, the binary digits of the rest."""
    rest = n % most
    return [most] * (n // most) + [
        1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1
    ]


class _Known(dict):
    """Ids of words; those of a word that is not there are made by ``learn`` when it is looked up.

    Once it holds half of ``most`` it is begun anew, and takes from the words it held before those
    that come again: what is rare goes and what is frequent stays.
    """

    def __init__(self, learn: Callable[[bytes], bytes], most: int):
        self.learn, self.half = learn, most // 2
        self.before: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.learn(word)
        if len(self) >= self.half:
            self.before = dict(self)
            self.clear()
        self[word] = ids
        return ids


class WordIds:
    """Token ids (little-endian, 32 bits each) of texts, put together from those of their words.

    For tokenizers that never join what white space parts, drop the white space and the case, and
    part letters from punctuation: a word's ids are then the same in any text, and words repeat.
    ``most`` words and their ids are kept (``CACHED_WORDS`` without it).
    """

    def __init__(self, path: str, most: int | None = None):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.known = _Known(self.learn, most or CACHED_WORDS)

    def learn(self, word: bytes) -> bytes:
        """Few stems have many endings and forms: each is asked for once."""
        if word.isalpha() and word.islower():
            return self.ask_symbols(word.decode())
        text = word.decode("utf-8", "replace")
        if _is_plain(text):
            low = text.lower()
            # They reach the vocabulary as the characters that stand for their bytes.
            return self.ask_symbols(low.translate(_SYMBOLS)) if low == text else self.known[low.encode()]
        stem = word.rstrip(_MARKS)
        if len(stem) < len(word) and _is_plain(stem.decode("utf-8", "replace")):
            return self.known[stem.lower()] + self.known[word[len(stem) :]]
        return self.ask(word)

    def ask_symbols(self, symbols: str) -> bytes:
        return array("I", [token.id for token in self.tokenize(symbols)]).tobytes()

    def ask(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text."""
        ids = self.known.__getitem__
        return [b"".join(map(ids, _lower(text).split())) for text in texts]


def _is_plain(text: str) -> bool:
    """Letters up to U+00FF have one lower case and no other form."""
    return text.isalpha() and max(text) <= "\xff"


def _lower(text: bytes) -> bytes:
    """A text of the same ids whose words repeat more: with A to Z in lower case."""
    # Accents that stand alone (U+0300 to U+037F) join some letters in one case only, and special
    # tokens have a case.
    if b"\xcc" in text or b"\xcd" in text or b"<|" in text:
        return text
    return text.lower()


def word_ids(path: str, most: int | None = None) -> WordIds:
    """The encoder of ``path`` that this Python worker has, with the words it knows; ``most`` are kept.

    It is kept with the tokenizers' module: globals of this one, which is shipped with the task,
    are made anew for every task.
    """
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_word_ids", {})
    if (path, most) not in kept:
        kept[path, most] = WordIds(path, most)
    return kept[path, most]


def pack(
    documents: DataFrame,
    make_encoder: Callable[[], Callable[[list[bytes]], list[bytes]]],
    text: str = "text",
    most: int = 2048,
    end_id: int = 1,
) -> DataFrame:
    """``documents`` without ``text``, a row per piece: ``piece`` (``start, length, doc_tokens,
    ids_crc32, ids``), ``bucket`` (its length), ``task`` and ``nth`` (of the bucket in the task).

    ``make_encoder`` makes, once per task, the function from UTF-8 texts to their ids as
    little-endian 32-bit numbers. ``most`` is a power of two.
    """
    if most & (most - 1):
        raise ValueError("the longest piece must be a power of two")
    end = end_id.to_bytes(4, "little")
    kept = [c for c in documents.columns if c != text and c.lower() not in RESULT]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, counts = make_encoder(), Counter()
        for batch in batches:
            encoded = encode(
                [memoryview(t.as_buffer()).tobytes() if t.is_valid else b"" for t in batch.column(0)]
            )
            rows, nths, origin = [], [], []
            for i, ids in enumerate(encoded):
                ids += end
                n, start = len(ids) // 4, 0
                for length in piece_lengths(n, most):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((start, length, n, zlib.crc32(own), own))
                    nths.append(counts[length])
                    counts[length] += 1
                    start += length
                    origin.append(i)
            columns = list(zip(*rows, strict=True)) or [[] for _ in PIECE]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, PIECE, strict=True)]
            own = pa.array(origin, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(c.take(own) for c in batch.columns[1:])]
                + [pa.StructArray.from_arrays(arrays, PIECE.names), pa.array(nths, pa.int64())],
                [*kept, "piece", "nth"],
            )

    rows = documents.select(F.col(text).cast("string"), *kept)
    schema = rows.select(
        *kept,
        F.lit(None).cast(f"struct<{PIECE_DDL}>").alias("piece"),
        F.lit(None).cast("long").alias("nth"),
    ).schema
    cut = rows.mapInArrow(pieces, schema)
    # Told by the task that counted: what follows reads other partitions.
    return cut.withColumns({"bucket": F.col("piece.length"), "task": F.spark_partition_id()})


def numbered(sequences: DataFrame) -> DataFrame:
    """``pack``'s sequences with ``place`` (gapless in the ``bucket``), ``sequence_id`` (unique)
    and ``offset`` (0, as a piece is a sequence), for ``task`` and ``nth``.

    Sequences are written before they are numbered, as another run of a task may cut other rows.
    What is added up is a count per task and length.
    """
    # Batches hold whole texts and their ids.
    with small_batches(sequences.sparkSession, BATCH):
        rows = staged(sequences, "sequences")
    counts = rows.groupBy("bucket", "task").agg((F.max("nth") + 1).alias("n"))
    before = Window.partitionBy("bucket").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("bucket", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = (F.col("first") + F.col("nth")).alias("place")
    kept = [c for c in rows.columns if c not in ("task", "nth")]
    placed = rows.join(starts, ["bucket", "task"]).select(*kept, place)
    # A bucket is a power of two: its exponent takes the last six bits.
    exponent = F.log2("bucket").cast("long")
    return placed.select(
        "*",
        F.shiftleft("place", 6).bitwiseOR(exponent).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(sequences: DataFrame, path: str) -> None:
    """Write sequences with a folder for each length."""
    sequences.write.partitionBy("bucket").parquet(path)
