"""Line dedup by pairwise alignment.

Lines that documents share are aligned, pair by pair, and what is aligned goes from the later
document. What makes a pair is a rare line hash: that of the shortest run of lines, begun or ended
at a line, that holds at least ``min_words`` words. A common short line is part of many such runs
and is none itself. A block of so many words in two documents is covered by runs within it, to its
last word: a line after the run that begins the block is the end of a run that does not leave it.

For each run the first document that holds it is the one to align with. So a passage that very
many documents share makes as many pairs as there are documents, and none is missed: the first
holder of any run has it whole. The n-th time that a document has a run it meets the n-th time
that the holder has it, or the first, if the holder has it less often. Only hashes and line
numbers travel to meet; texts go once to their own document's result.

Two rules decide what goes:

* *Aligned.* A pair's matching runs are put together to common blocks, and these are aligned as
  in a patience diff: of the blocks that share no line with another, on either side, a longest
  increasing sequence is taken; between two that are taken, a longest increasing sequence of the
  others, without the lines that are taken already. A block that crosses these was moved or
  repeated, and stays.
* *Moved.* A stretch of lines that earlier documents have, of ``moved_words`` words or more, goes
  wherever it stands, aligned or not. None turns this rule off.

Documents are ordered by key, then by a hash of their text. Defined results: lines are compared
without white space at their ends; a null or empty text has no lines and stays as it is; a text of
any length is read whole, in time of its lines times their logarithm; an empty table gives no
rows; rows equal in key and text are one document and are treated alike; null keys come last;
lines without a word go only inside a block, not at its ends; a document whose lines all go has an
empty text. Columns of the input are kept; the result is one struct column (``text, n_lines,
n_deleted, deleted_words, spans``) under a name not yet taken.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, once, small_batches, staged

# Rows of a batch of texts.
BATCH = 1000

RUN = pa.struct(
    [("run", pa.int64()), ("nth", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]
)
RUN_DDL = "run long, nth int, start int, stop int"
RESULT = pa.struct(
    [("text", pa.string()), ("n_lines", pa.int64()), ("n_deleted", pa.int64())]
    + [("deleted_words", pa.int64()), ("spans", pa.string())]
)
RESULT_DDL = "text string, n_lines long, n_deleted long, deleted_words long, spans string"


def lines_of(data: bytes) -> list[bytes]:
    return data.split(b"\n") if data else []


def words_of(lines: list[bytes]) -> np.ndarray:
    return np.array([len(line.split()) for line in lines], np.int64)


def runs(lines: list[bytes], min_words: int) -> list[tuple[int, int, int]]:
    """Hash, first line and line after the last of the shortest runs of ``min_words`` words that
    begin and that end at each line with a word."""
    words = words_of(lines)
    ends = np.concatenate([[0], np.cumsum(words)])
    if ends[-1] < min_words:
        return []
    hashes = [xxhash.xxh3_64_intdigest(line.strip()) for line in lines]
    at = np.flatnonzero(words)
    stops = np.searchsorted(ends, ends[at] + min_words)
    starts = np.searchsorted(ends, ends[at + 1] - min_words, side="right") - 1
    begun = stops <= len(lines)
    ended = starts >= 0
    found = set(zip(at[begun].tolist(), stops[begun].tolist(), strict=True))
    found.update(zip(starts[ended].tolist(), (at[ended] + 1).tolist(), strict=True))
    out = []
    for start, stop in sorted(found):
        run = xxhash.xxh3_64_intdigest(np.array(hashes[start:stop], np.uint64).tobytes())
        out.append((run - (1 << 63), start, stop))
    return out


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing sequence, by patience sorting."""
    tops, piles, before = [], [], []
    for i, value in enumerate(values):
        pile = bisect_left(tops, value)
        before.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            piles.append(i)
        else:
            tops[pile], piles[pile] = value, i
    chain, i = [], piles[-1] if piles else -1
    while i >= 0:
        chain.append(i)
        i = before[i]
    return chain[::-1]


# The earlier document's first line, the later one's, and the later one's line after the last.
Block = tuple[int, int, int]


def common_blocks(matches: list[Block]) -> list[Block]:
    """Matching runs as blocks: those of one offset that overlap or touch are one."""
    out: list[list[int]] = []
    for there, here, stop in sorted(matches, key=lambda m: (m[0] - m[1], m[1])):
        last = out[-1] if out else None
        if last and last[0] - last[1] == there - here and here <= last[2]:
            last[2] = max(last[2], stop)
        else:
            out.append([there, here, stop])
    return [tuple(block) for block in out]


def alone(spans: list[tuple[int, int]]) -> list[bool]:
    """Whether a span overlaps no other."""
    order = sorted(range(len(spans)), key=spans.__getitem__)
    out = [True] * len(spans)
    furthest, holder = -1, -1
    for i in order:
        start, stop = spans[i]
        if start < furthest:
            out[i] = out[holder] = False
        if stop > furthest:
            furthest, holder = stop, i
    return out


def increasing(blocks: list[Block]) -> list[Block]:
    """A longest sequence of blocks whose first lines increase on both sides."""
    # Of blocks that begin at one line here, at most one is taken: the others do not increase.
    blocks = sorted(blocks, key=lambda b: (b[1], -b[0]))
    return [blocks[i] for i in longest_increasing([there for there, _, _ in blocks])]


def align(matches: list[Block]) -> list[tuple[int, int]]:
    """Blocks ``(first line, line after the last)`` of the later document that a patience diff
    with the earlier one aligns, from matching runs."""
    blocks = common_blocks(matches)
    here = alone([(start, stop) for _, start, stop in blocks])
    there = alone([(first, first + stop - start) for first, start, stop in blocks])
    anchors = increasing(
        [block for block, a, b in zip(blocks, here, there, strict=True) if a and b]
    )
    others = sorted(set(blocks) - set(anchors), key=lambda block: block[1])
    out = [(start, stop) for _, start, stop in anchors]
    end = 1 << 40
    at = 0
    bounds = [(0, 0, 0), *anchors, (end, end, end)]
    for (first, start, stop), (next_there, next_here, _) in pairwise(bounds):
        # What is open lies, on both sides, between two anchors. Anchors overlap no other block
        # here, so each of these is in one gap as a whole.
        open_there, open_here = first + stop - start, stop
        inside = []
        while at < len(others) and others[at][1] < next_here:
            if cut := clipped(others[at], open_there, open_here, next_there, next_here):
                inside.append(cut)
            at += 1
        for block in increasing(inside):
            if cut := clipped(block, open_there, open_here, next_there, next_here):
                out.append((cut[1], cut[2]))
                open_there, open_here = cut[0] + cut[2] - cut[1], cut[2]
    return merged(out)


def clipped(block: Block, there: int, here: int, there_end: int, here_end: int) -> Block | None:
    """The part of a block within these lines."""
    offset = block[0] - block[1]
    start = max(block[1], here, there - offset)
    stop = min(block[2], here_end, there_end - offset)
    return (start + offset, start, stop) if start < stop else None


def decided(
    pairs: list[list[Block]], words: np.ndarray, moved_words: int | None
) -> list[tuple[int, int]]:
    """Lines that go from a document, given its matches with each earlier one."""
    blocks = [block for matches in pairs for block in align(matches)]
    if moved_words is not None:
        ends = np.concatenate([[0], np.cumsum(words)])
        stretches = merged([(here, stop) for matches in pairs for _, here, stop in matches])
        blocks += [(a, b) for a, b in stretches if ends[b] - ends[a] >= moved_words]
    return merged(blocks)


def merged(blocks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted(blocks):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(start, stop) for start, stop in out]


def delete_lines(data: bytes, blocks: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The text without the blocks, how many lines that were, and how many words."""
    lines = lines_of(data)
    kept, gone, at = [], [], 0
    for start, stop in blocks:
        kept += lines[at:start]
        gone += lines[start:stop]
        at = stop
    kept += lines[at:]
    return b"\n".join(kept), len(gone), sum(len(line.split()) for line in gone)


def dedup_lines(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_words: int = 30,
    moved_words: int | None = 50,
    result: str = "deduped",
) -> tuple[DataFrame, str]:
    """``documents`` with a struct of the text that is left and what was deleted, and the name of
    that column."""

    def runs_of(texts: pa.Array) -> pa.Array:
        rows, ends = [], [0]
        for t in texts:
            data = memoryview(t.as_buffer()).tobytes() if t.is_valid else b""
            times: Counter[int] = Counter()
            for run, start, stop in runs(lines_of(data), min_words):
                times[run] += 1
                rows.append((run, times[run], start, stop))
            ends.append(len(rows))
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, RUN, strict=True)]
        return pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.StructArray.from_arrays(arrays, RUN.names)
        )

    def clean(texts: pa.Array, matches: pa.Array) -> pa.Array:
        out = []
        for t, found in zip(texts, matches.to_pylist(), strict=True):
            data = memoryview(t.as_buffer()).tobytes() if t.is_valid else b""
            pairs = defaultdict(list)
            for m in found or ():
                pairs[m["first_key"], m["first_print"]].append((m["there"], m["start"], m["stop"]))
            words = words_of(lines_of(data)) if pairs else None
            blocks = decided(list(pairs.values()), words, moved_words) if pairs else []
            rest, n, words = delete_lines(data, blocks) if blocks else (data, 0, 0)
            spans = ",".join(f"{start}:{stop}" for start, stop in blocks)
            rest = rest.decode("utf-8", "replace") if t.is_valid else None
            out.append((rest, len(lines_of(data)), n, words, spans))
        columns = list(zip(*out, strict=True)) or [[] for _ in RESULT]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, RESULT, strict=True)]
        return pa.StructArray.from_arrays(arrays, RESULT.names)

    value = F.col(text).cast("string")
    print_ = F.xxhash64(F.struct(key), value)
    found = documents.select(
        F.col(key).alias("key"),
        print_.alias("print"),
        F.inline(F.arrow_udf(runs_of, f"array<struct<{RUN_DDL}>>")(value)),
    )
    with small_batches(documents.sparkSession, BATCH):
        found = staged(found, "runs")
    # The first holder is the least of key, text and line; a run within one document has no other.
    holder = F.struct(F.col("key").isNull().alias("nameless"), "key", "print")
    place = F.struct(F.col("key").isNull().alias("nameless"), "key", "print", "start")
    holders = (
        found.groupBy("run")
        .agg(F.min(place).alias("first"), F.max(holder).alias("last"))
        .where(~(F.struct("first.nameless", "first.key", "first.print").eqNullSafe(F.col("last"))))
        .select(
            "run",
            F.col("first.key").alias("first_key"),
            F.col("first.print").alias("first_print"),
            F.col("first.start").alias("there"),
        )
    )
    same = F.col("key").eqNullSafe(F.col("first_key")) & (F.col("print") == F.col("first_print"))
    matches = found.join(holders, "run").where(~same)
    # Where the holder has the run again; rows alike are one document.
    again = (
        found.where("nth > 1")
        .select(
            F.col("run").alias("again_run"),
            F.col("nth").alias("again_nth"),
            F.col("key").alias("again_key"),
            F.col("print").alias("again_print"),
            F.col("start").alias("again"),
        )
        .distinct()
    )
    matches = matches.join(
        again,
        (F.col("run") == F.col("again_run"))
        & (F.col("nth") == F.col("again_nth"))
        & F.col("first_key").eqNullSafe(F.col("again_key"))
        & (F.col("first_print") == F.col("again_print")),
        "left",
    ).withColumn("there", F.coalesce("again", "there"))
    # Runs of one document, so no more than it has lines.
    names = [free_name(documents, n) for n in (result, "match_key", "match_print", "matches")]
    name, match_key, match_print, listed = names
    fields = F.struct("first_key", "first_print", "there", "start", "stop")
    matches = (
        matches.groupBy(F.col("key").alias(match_key), F.col("print").alias(match_print))
        .agg(F.collect_set(fields).alias(listed))
    )
    marked = documents.withColumn(name, print_)
    both = marked[name].eqNullSafe(matches[match_print]) & marked[key].eqNullSafe(
        matches[match_key]
    )
    joined = marked.join(matches, both, "left")
    cleaned = once(F.arrow_udf(clean, RESULT_DDL))(value, F.col(listed))
    columns = [marked[c] for c in documents.columns]
    return joined.select(*columns, cleaned.alias(name)), name
