"""Token ids as grammar-compressed files (Re-Pair), read again whole or in part.

Documents are sorted by id, encoded and written in shards. In a shard the pairs of neighbouring
symbols that occur most often are replaced by new symbols (nonterminals), again and again, until
a round saves too little. A round replaces all frequent pairs of which none can overlap another:
the most frequent goes first and fixes for its symbols on which side of a pair they may stand.
A pair never spans two documents.

A file holds the rules with the number of ids each expands to, an index of documents (id, first
symbol, first token) and the symbols, in 16 bits where they fit. Any stretch of a document is
decoded from the rules and that document's symbols alone.

Each task writes its shards under names of their own and lists them in a table that Spark commits,
so what a lost or repeated task left behind is never read. Shards follow one another in the order
of ids; how many tokens come before a shard is summed from their sizes.

Defined results: a null text is empty, and an empty document is its end token alone; a null id
comes first; rows with one id are documents each by itself, in any order among equal texts. Texts
of any length are encoded whole; one that is longer than a shard is a shard. An empty table gives
no file and no rows. Columns other than id and text do not matter, whatever their names.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder
from ..sinks import open_files
from .common import small_batches, staged

Encoder = Callable[[list[bytes]], list[bytes]]

SHARD_TOKENS = 1 << 21
LEAST = 64  # times that a pair must occur
LEAST_GAIN = 0.03  # share of the symbols that a round must save to be followed by another
ROUNDS = 64

MAGIC = b"REPAIR01"
HEAD = "<8sQQQQQ"  # magic, first nonterminal, rules, documents, symbols, their bytes
SHARDS = (
    "path string, part int, number int, n_docs long, n_tokens long, n_symbols long, n_rules long, "
    "n_bytes long"
)
# Large odd numbers that spread the two symbols of a pair over cells.
_SPREAD = (2654435761, 2246822519)


def _frequent(
    symbols: np.ndarray, last: np.ndarray, turn: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Frequent pairs, how often they occur, where, and which of the pairs it is.

    Pairs are counted in cells of a hash. Of the pairs of one cell one is taken, in most cases the
    most frequent; the others have their turn with the next hash.
    """
    bits = max(10, min(18, len(symbols).bit_length() - 1))
    left, right = (np.uint32((k + 2 * turn) % (1 << 32)) for k in _SPREAD)
    cell = symbols[:-1] * left
    cell += symbols[1:] * right
    cell >>= np.uint32(32 - bits)
    # No pair spans two documents; the one cell that stands for such places is passed over.
    cell[last[:-1]] = 0
    hot = np.bincount(cell, minlength=1 << bits) >= LEAST
    hot[0] = False
    here = np.flatnonzero(hot.take(cell))
    cell = cell.take(here)
    key = symbols.take(here).astype(np.uint64)
    key <<= np.uint64(32)
    key |= symbols.take(here + 1)
    holder = np.zeros(1 << bits, np.uint64)
    holder[cell] = key
    own = np.flatnonzero(holder.take(cell) == key)
    here, cell = here.take(own), cell.take(own)
    count = np.bincount(cell, minlength=1 << bits)
    cells = np.flatnonzero(count >= LEAST)
    number = np.full(1 << bits, -1, np.int32)
    number[cells] = np.arange(len(cells))
    place = number.take(cell)
    frequent = np.flatnonzero(place >= 0)
    return holder[cells], count[cells], here.take(frequent), place.take(frequent)


def _compatible(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Numbers of the pairs to replace, the most frequent first.

    A symbol stands on the left of the pairs that are taken, or on the right, or in a pair with
    itself.
    """
    role: dict[int, str] = {}
    taken = []
    order = np.lexsort((pairs, -counts))
    lefts, rights = (pairs >> np.uint64(32))[order].tolist(), (pairs & np.uint64(0xFFFFFFFF))[order].tolist()
    for i, a, b in zip(order.tolist(), lefts, rights, strict=True):
        if a == b:
            free = a not in role
            sides = ("both", "both")
        else:
            free = role.get(a, "left") == "left" and role.get(b, "right") == "right"
            sides = ("left", "right")
        if free:
            role[a], role[b] = sides
            taken.append(i)
    return np.array(taken, np.int64)


def compress(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Symbols, their number per document, rules (left, right), and the first nonterminal.

    ``ends`` are the numbers of ids up to the end of each document; no document is empty.
    """
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(ids), bool)
    last[ends - 1] = True
    base = int(ids.max(initial=0)) + 1
    rules = [np.zeros((0, 2), np.uint32)]
    made = 0
    for turn in range(ROUNDS):
        if len(symbols) < 2:
            break
        pairs, counts, here, place = _frequent(symbols, last, turn)
        taken = _compatible(pairs, counts)
        if not len(taken):
            break
        name = np.zeros(len(pairs), np.uint32)
        name[taken] = base + made + np.arange(len(taken))
        new = name.take(place)
        named = np.flatnonzero(new)
        here, new = here.take(named), new.take(named)
        # In a run of one symbol every other pair is replaced.
        starts = np.flatnonzero(np.diff(here, prepend=-2) != 1)
        even = (np.arange(len(here)) - np.repeat(starts, np.diff(starts, append=len(here)))) % 2 == 0
        here, new = here[even], new[even]
        symbols[here] = new
        last[here] |= last[here + 1]
        keep = np.ones(len(symbols), bool)
        keep[here + 1] = False
        before = len(symbols)
        left = np.flatnonzero(keep)
        symbols, last = symbols.take(left), last.take(left)
        chosen = pairs[taken]
        rules.append(np.stack([chosen >> np.uint64(32), chosen & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        made += len(taken)
        if before - len(symbols) < LEAST_GAIN * before:
            break
    sizes = np.diff(np.flatnonzero(last), prepend=-1)
    return symbols, sizes, np.concatenate(rules), base


class Rules:
    """Expansions of the symbols of a shard."""

    def __init__(self, rules: np.ndarray, lengths: np.ndarray, base: int):
        self.rules, self.base = rules, base
        # Rules name older symbols only. Ids expand to themselves.
        known = [np.arange(base, dtype=np.uint32)]
        self.lengths = np.concatenate([np.ones(base, np.int64), lengths])
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        whole: list[np.ndarray] = []
        for a, b in rules.tolist():
            sides = [whole[s - base] if s >= base else known[0][s : s + 1] for s in (a, b)]
            whole.append(np.concatenate(sides))
        self.table = np.concatenate(known + whole)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        sizes = self.lengths[symbols]
        before = np.cumsum(sizes) - sizes
        return self.table[np.arange(sizes.sum()) + np.repeat(self.starts[symbols] - before, sizes)]

    def stretch(self, symbols: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of what ``symbols`` expand to; only symbols that hold some
        of them are expanded."""
        after = np.cumsum(self.lengths[symbols])
        first, last = np.searchsorted(after, [start, stop - 1], "right")
        skipped = int(after[first - 1]) if first else 0
        return self.expand(symbols[first : last + 1])[start - skipped : stop - skipped]


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    lengths: list[int] = []
    for a, b in rules.tolist():
        lengths.append(sum(lengths[s - base] if s >= base else 1 for s in (a, b)))
    return np.array(lengths, np.int64)


def pack_shard(doc_ids: list[int | None], encoded: list[bytes]) -> tuple[bytes, int, int, int]:
    """A shard's file, and its numbers of tokens, symbols and rules."""
    counts = np.array([len(e) // 4 for e in encoded], np.int64)
    tokens = np.concatenate([[0], np.cumsum(counts)])
    symbols, sizes, rules, base = compress(np.frombuffer(b"".join(encoded), "<u4"), tokens[1:])
    width = 2 if base + len(rules) <= 1 << 16 else 4
    parts = [
        struct.pack(HEAD, MAGIC, base, len(rules), len(doc_ids), len(symbols), width),
        rules.astype("<u4").tobytes(),
        expansion_lengths(rules, base).astype("<i8").tobytes(),
        np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
        np.array([i is None for i in doc_ids], "u1").tobytes(),
        np.concatenate([[0], np.cumsum(sizes)]).astype("<i8").tobytes(),
        tokens.astype("<i8").tobytes(),
        symbols.astype(f"<u{width}").tobytes(),
    ]
    return b"".join(parts), int(tokens[-1]), len(symbols), len(rules)


class Shard:
    """A shard file: its rules and index are read at once, symbols when asked for."""

    def __init__(self, path: str):
        files, plain = open_files(path)
        self.file = files.open_input_file(plain)
        magic, base, n_rules, n_docs, self.n_symbols, self.width = struct.unpack(
            HEAD, self.file.read(struct.calcsize(HEAD))
        )
        if magic != MAGIC:
            raise ValueError(f"{path} is no shard")
        rules = self._array("<u4", 2 * n_rules).reshape(-1, 2)
        self.rules = Rules(rules, self._array("<i8", n_rules), base)
        ids, null = self._array("<i8", n_docs).tolist(), self._array("u1", n_docs)
        self.doc_ids = [None if n else i for i, n in zip(ids, null, strict=True)]
        self.symbols_at, self.tokens_at = self._array("<i8", n_docs + 1), self._array("<i8", n_docs + 1)
        self.data_at = self.file.tell()

    def _array(self, kind: str, n: int) -> np.ndarray:
        return np.frombuffer(self.file.read(n * np.dtype(kind).itemsize), kind)

    def symbols(self, first: int, last: int) -> np.ndarray:
        self.file.seek(self.data_at + first * self.width)
        return self._array(f"<u{self.width}", last - first)

    def tokens(self, doc: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids of the ``doc``-th document, or a stretch of them; no other symbols are read."""
        n = int(self.tokens_at[doc + 1] - self.tokens_at[doc])
        stop = n if stop is None else min(stop, n)
        if start >= stop:
            return np.zeros(0, np.uint32)
        return self.rules.stretch(self.symbols(*self.symbols_at[doc : doc + 2]), start, stop)

    def documents(self, together: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
        """All documents as number and ids, about ``together`` symbols at a time."""
        doc, n = 0, len(self.doc_ids)
        while doc < n:
            stop = int(np.searchsorted(self.symbols_at, self.symbols_at[doc] + together, "right")) - 1
            stop = min(n, max(stop, doc + 1))
            ids = self.rules.expand(self.symbols(self.symbols_at[doc], self.symbols_at[stop]))
            base = self.tokens_at[doc]
            for i in range(doc, stop):
                yield i, ids[self.tokens_at[i] - base : self.tokens_at[i + 1] - base]
            doc = stop

    def close(self) -> None:
        self.file.close()


def write_shards(
    documents: DataFrame, folder: str, make_encoder: Callable[[], Encoder], end_id: int = 1
) -> DataFrame:
    """Write ``documents`` (``id, text``) in ascending order of id as shards below ``folder``; the
    table of shards."""
    end = end_id.to_bytes(4, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = make_encoder()
        files, root = open_files(folder)
        part = TaskContext.get().partitionId()
        ids: list[int | None] = []
        encoded: list[bytes] = []
        number = size = 0

        def cut() -> pa.RecordBatch:
            data, n_tokens, n_symbols, n_rules = pack_shard(ids, encoded)
            name = f"{part:06d}-{number:06d}-{uuid.uuid4().hex}.repair"
            files.create_dir(root, recursive=True)
            with files.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(data)
            row = (f"{folder}/{name}", part, number, len(ids), n_tokens, n_symbols, n_rules, len(data))
            kinds = [pa.string(), pa.int32(), pa.int32()] + [pa.int64()] * 5
            names = [c.split()[0] for c in SHARDS.split(", ")]
            arrays = [pa.array([v], k) for v, k in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            texts = [memoryview(t.as_buffer()).tobytes() if t.is_valid else b"" for t in batch.column(1)]
            for doc_id, own in zip(batch.column(0).to_pylist(), encoder(texts), strict=True):
                ids.append(doc_id)
                encoded.append(own + end)
                size += len(own) // 4 + 1
                if size >= SHARD_TOKENS:
                    yield cut()
                    ids, encoded, number, size = [], [], number + 1, 0
        if ids:
            yield cut()

    # Many rows of one id, or of one id and text, are dealt to several tasks too.
    order = ["id", "_text", "_row"]
    keyed = documents.select(
        "id", "text", F.xxhash64("text").alias("_text"), F.monotonically_increasing_id().alias("_row")
    )
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    # Batches hold whole texts.
    with small_batches(documents.sparkSession, 500):
        return staged(ranged.mapInArrow(write, SHARDS), "shards")


def with_starts(shards: DataFrame) -> DataFrame:
    """``shards`` with ``start``, the number of tokens in all shards before."""
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("_tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_tokens").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    return shards.join(parts, "part").select(*shards.columns, (F.col("_before") + inside).alias("start"))


def read_shards(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(path)
                found = [
                    (start + int(shard.tokens_at[i]), len(ids), zlib.crc32(ids))
                    for i, ids in shard.documents()
                ]
                shard.close()
                columns = [shard.doc_ids, *zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    # Rows are small and their files are not: the number of tasks is set.
    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = with_starts(shards).select("path", "start").repartition(n, "path")
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_tokens(
    documents: DataFrame,
    make_encoder: Callable[[], Encoder],
    folder: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 1,
) -> DataFrame:
    """Encode ``documents`` into shards below ``folder`` (a shared one, if none is named); the
    table of shards. ``make_encoder`` makes, once per task, the function from UTF-8 texts to ids
    as little-endian 32-bit numbers. Ids of documents are long."""
    rows = documents.select(
        F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")
    )
    folder = folder or shared_folder(documents.sparkSession, "tokens")
    return write_shards(rows, folder, make_encoder, end_id)
