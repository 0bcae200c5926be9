"""Vector code compression: product codes whose codebooks are learned over metric trees.

A vector is cut into equal parts, and each part is coded by the nearest entry of its position's
codebook. Vectors are read into blocks, and over each part of a block an anchors hierarchy is
built once: anchors take over the points that are nearer to them than to their first anchor,
about as many as the root of the points; from there (the middle) balls are merged upwards, the
pair with the smallest common ball first, and every anchor's points are split downwards in the
same way. A ball caches the sum and the number of its points.

A round of learning walks the trees with the codebook. A ball inherits the list of entries that
may own one of its points, and drops those that the hyperplane between them and the entry nearest
to its pivot keeps out of the ball. Once one entry is left, it owns the ball: cached sums are
added and nothing below is visited. Points of leaves that are still shared are compared with the
entries left. All decisions are exact: components are integers, what floating point decides has a
margin, ties go to the lower entry.

Trees are written once and read by every round. A task gives one number per component and entry,
combined by Spark; the driver sees only the codebooks, whose size the parameters bound.

Defined results: vectors that are null, empty or hold nulls, NaN or infinite values take no part. A null
id is an id and comes last; rows with one id are coded each by itself, the lesser vector first.
With fewer vectors than entries, codebooks are that much shorter. An empty table gives no rows.
Vectors of different lengths, of a length that the parts do not divide, or with components
beyond what 64-bit distances hold, raise an error. Columns other than id, vector and label do not
matter, whatever their names; there are no texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_counted
from .common import staged

BLOCK = 16_384  # vectors over which trees are built together
BLOCK_BYTES = 32 << 20
LEAF = 96  # points of a ball that is not split
WORK = 1 << 20  # distances that are worked out together

TREE = "order binary, points binary, lows binary, highs binary, lefts binary, rights binary, " \
    "pivots binary, radii binary, sums binary"  # fmt: skip
_TREE = pa.struct([(f.split()[0], pa.binary()) for f in TREE.split(", ")])


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of points along the last axis."""
    apart = x - y
    return np.einsum("...i,...i->...", apart, apart)


def anchors(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows of ``x`` by the anchor that owns them; equal points never part.

    The next anchor is the point farthest from its own. An owner's point that is nearer to it than
    half of its way to the new anchor stays, and no distance is asked for.
    """
    owner, pivots = np.zeros(len(x), np.int64), [0]
    far = squares(x, x[0])
    while len(pivots) < most:
        new = int(far.argmax())
        if far[new] == 0:
            break
        between = squares(x[pivots], x[new])
        asked = np.flatnonzero(4.0 * far > between[owner])
        distance = squares(x[asked], x[new])
        won = distance < far[asked]
        owner[asked[won]], far[asked[won]] = len(pivots), distance[won]
        pivots.append(new)
    by_owner = np.argsort(owner, kind="stable")
    return np.split(by_owner, np.cumsum(np.bincount(owner, minlength=len(pivots)))[:-1])


def merges(centres: np.ndarray, radii: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of balls in the order they are merged; the n-th merge makes ball ``len(radii) + n``."""
    n = len(radii)
    centres, radii, sizes = centres.astype(float), radii.copy(), sizes.astype(float)
    name, out = list(range(n)), []
    common = np.sqrt(squares(centres[:, None], centres[None])) + radii[:, None] + radii[None]
    np.fill_diagonal(common, np.inf)
    for step in range(n - 1):
        a, b = divmod(int(common.argmin()), n)
        out.append((name[a], name[b]))
        radii[a] = max(common[a, b] / 2, radii[a], radii[b])
        centres[a] = (centres[a] * sizes[a] + centres[b] * sizes[b]) / (sizes[a] + sizes[b])
        sizes[a] += sizes[b]
        name[a] = n + step
        apart = np.sqrt(squares(centres, centres[a])) + radii + radii[a]
        alive = np.isfinite(common[a])
        alive[[a, b]] = False
        common[a] = common[:, a] = np.where(alive, apart, np.inf)
        common[b] = common[:, b] = np.inf
    return out


class Tree:
    """A metric tree: points in the order of its leaves, balls as ranges of them."""

    def __init__(self, x: np.ndarray):
        children, leaves = self._split(x)
        self._lay_out(children, leaves)
        self.points = x[self.order]
        self._measure()

    def _split(self, x: np.ndarray) -> tuple[dict[int, tuple[int, int]], dict[int, np.ndarray]]:
        """Children of the inner balls and rows of the leaves; ball 0 is the root."""
        children: dict[int, tuple[int, int]] = {}
        leaves: dict[int, np.ndarray] = {}
        waiting, made = [(0, np.arange(len(x)))], 1
        while waiting:
            ball, rows = waiting.pop()
            groups = [rows]
            if len(rows) > LEAF:
                groups = [rows[g] for g in anchors(x[rows], int(np.ceil(len(rows) ** 0.5)))]
            if len(groups) == 1:
                leaves[ball] = rows
                continue
            sizes = np.array([len(g) for g in groups])
            starts, inside = np.cumsum(sizes) - sizes, x[np.concatenate(groups)]
            centres = np.add.reduceat(inside, starts) / sizes[:, None]
            far = squares(inside, np.repeat(centres, sizes, axis=0))
            pairs = merges(centres, np.sqrt(np.maximum.reduceat(far, starts)), sizes)
            last = len(groups) + len(pairs) - 1
            # The last merge is the ball that is split; others are new.
            number = {last: ball}
            for i in range(last):
                number[i] = made + i
            made += last
            for i, (a, b) in enumerate(pairs):
                children[number[len(groups) + i]] = (number[a], number[b])
            waiting += [(number[i], g) for i, g in enumerate(groups)]
        return children, leaves

    def _lay_out(self, children: dict, leaves: dict) -> None:
        n = len(children) + len(leaves)
        self.lows, self.highs = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.lefts, self.rights = np.full(n, -1), np.full(n, -1)
        at, order, stack = 0, [], [(0, False)]
        while stack:
            ball, back = stack.pop()
            if back:
                left, right = children[ball]
                self.lows[ball], self.highs[ball] = self.lows[left], self.highs[right]
            elif ball in leaves:
                order.append(leaves[ball])
                self.lows[ball], self.highs[ball] = at, at + len(leaves[ball])
                at += len(leaves[ball])
            else:
                left, right = self.lefts[ball], self.rights[ball] = children[ball]
                stack += [(ball, True), (right, False), (left, False)]
        self.order = np.concatenate(order)

    def _measure(self) -> None:
        """Sums, pivots and radii; balls of one depth do not overlap, so they are done together."""
        total = np.vstack([np.zeros((1, self.points.shape[1]), np.int64), self.points.cumsum(axis=0)])
        self.sums = total[self.highs] - total[self.lows]
        counts = (self.highs - self.lows)[:, None]
        self.pivots = (2 * self.sums + counts) // (2 * counts)
        self.radii = np.zeros(len(counts))
        level = np.zeros(1, np.int64)
        while len(level):
            level = level[np.argsort(self.lows[level])]
            rows, own = ranges(self.lows[level], self.highs[level])
            far = squares(self.points[rows], self.pivots[level][own])
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            self.radii[level] = np.sqrt(np.maximum.reduceat(far, starts).astype(float))
            inner = level[self.lefts[level] >= 0]
            level = np.concatenate([self.lefts[inner], self.rights[inner]])

    def pack(self) -> dict[str, bytes]:
        return {f.name: np.ascontiguousarray(getattr(self, f.name)).tobytes() for f in _TREE}

    @classmethod
    def unpack(cls, packed: dict[str, bytes], width: int) -> Tree:
        tree = cls.__new__(cls)
        for name, data in packed.items():
            array = np.frombuffer(data, np.float64 if name == "radii" else np.int64)
            wide = name in ("points", "pivots", "sums")
            setattr(tree, name, array.reshape(-1, width) if wide else array)
        return tree


def ranges(lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each low to before its high, and which range each is of."""
    sizes = highs - lows
    own = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - lows, sizes), own


def walk(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Balls that one entry owns, and that entry; points of shared leaves, and their entries."""
    between = np.sqrt(squares(entries[:, None], entries[None]).astype(float))
    # Of equal entries the first takes all.
    first = ~np.tril(between == 0, -1).any(axis=1)
    balls, listed = np.zeros(1, np.int64), first[None].copy()
    owned, owners, shared, lists = [], [], [], []
    while len(balls):
        distance = squares(tree.pivots[balls][:, None], entries[None])
        best = np.where(listed, distance, np.iinfo(np.int64).max).argmin(axis=1)
        row = np.arange(len(balls))
        behind = (distance - distance[row, best][:, None]).astype(float)
        reach = 2 * tree.radii[balls][:, None] * between[best] * (1 + 1e-9)
        listed = listed & (behind <= reach) & (tree.radii[balls] > 0)[:, None]
        listed[row, best] = True
        whole = listed.sum(axis=1) == 1
        owned.append(balls[whole])
        owners.append(best[whole])
        leaf = ~whole & (tree.lefts[balls] < 0)
        shared.append(balls[leaf])
        lists.append(listed[leaf])
        inner = ~whole & ~leaf
        balls = np.concatenate([tree.lefts[balls[inner]], tree.rights[balls[inner]]])
        listed = np.concatenate([listed[inner], listed[inner]])
    rows, chosen = _nearest(tree, entries, np.concatenate(shared), np.concatenate(lists))
    return np.concatenate(owned), np.concatenate(owners), rows, chosen


def _nearest(
    tree: Tree, entries: np.ndarray, leaves: np.ndarray, listed: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Points of ``leaves`` and, of the entries listed for their leaf, the nearest."""
    rows, chosen = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    many = listed.sum(axis=1)
    at_least = 0
    while at_least < len(entries):
        at_most = max(2, 2 * at_least)
        here = np.flatnonzero((many > at_least) & (many <= at_most))
        at_least = at_most
        if not len(here):
            continue
        # Those listed come first, by number; shorter lists repeat their first.
        lists = np.argsort(~listed[here], axis=1, kind="stable")[:, :at_most]
        lists = np.where(np.arange(lists.shape[1]) < many[here][:, None], lists, lists[:, :1])
        points, own = ranges(tree.lows[leaves[here]], tree.highs[leaves[here]])
        step = max(1, WORK // lists.shape[1])
        for i in range(0, len(points), step):
            part, asked = points[i : i + step], lists[own[i : i + step]]
            near = squares(tree.points[part][:, None], entries[asked]).argmin(axis=1)
            rows.append(part)
            chosen.append(asked[np.arange(len(part)), near])
    return np.concatenate(rows), np.concatenate(chosen)


def owned_sums(tree: Tree, entries: np.ndarray) -> np.ndarray:
    """Per entry the sum of the components of its points and, last, their number."""
    balls, owners, rows, chosen = walk(tree, entries)
    counts = tree.highs - tree.lows
    out = np.zeros((len(entries), entries.shape[1] + 1), np.int64)
    np.add.at(out[:, :-1], owners, tree.sums[balls])
    np.add.at(out[:, -1], owners, counts[balls])
    np.add.at(out[:, :-1], chosen, tree.points[rows])
    out[:, -1] += np.bincount(chosen, minlength=len(entries))
    return out


def assigned(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each point, in the order the points came in."""
    balls, owners, rows, chosen = walk(tree, entries)
    entry = np.zeros(len(tree.points), np.int64)
    inside, own = ranges(tree.lows[balls], tree.highs[balls])
    entry[inside], entry[rows] = owners[own], chosen
    out, error = np.empty_like(entry), np.empty_like(entry)
    out[tree.order], error[tree.order] = entry, squares(tree.points, entries[entry])
    return out, error


def _whole(vectors: pa.Array, parts: int, width: int) -> np.ndarray:
    """Vectors as integers, ``floor(256 * component)``."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != len(vectors) * parts * width or (
        np.diff(vectors.offsets.to_numpy()) != parts * width
    ).any():
        raise ValueError("vectors have different lengths")
    scaled = np.floor(256 * flat)
    # Squared distances, and the sums of a block, fit 64 bits.
    limit = min((2.0**61 / width) ** 0.5 / 2, 2.0**46)
    if (np.abs(scaled) > limit).any():
        raise ValueError(f"a component is beyond {limit / 256:.0f}: distances do not fit 64 bits")
    return scaled.astype(np.int64).reshape(len(vectors), parts * width)


def _codebook(x: np.ndarray, parts: int) -> np.ndarray:
    return np.ascontiguousarray(x.reshape(len(x), parts, x.shape[1] // parts).swapaxes(0, 1))


def blocks(rows: DataFrame, parts: int, width: int) -> DataFrame:
    """``id, label, vector`` as blocks: their ids and labels, and a tree per part."""
    block = min(BLOCK, max(1, BLOCK_BYTES // (8 * parts * width)))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0

        def cut(one: pa.Table) -> pa.RecordBatch:
            x = _whole(one["vector"].combine_chunks(), parts, width)
            trees = [Tree(x[:, p * width : (p + 1) * width]).pack() for p in range(parts)]
            columns = [
                pa.ListArray.from_arrays([0, len(one)], one[c].combine_chunks())
                for c in ("id", "label")
            ]
            columns.append(pa.array([trees], pa.list_(_TREE)))
            return pa.RecordBatch.from_arrays(columns, ["ids", "labels", "trees"])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= block:
                whole = pa.Table.from_batches(held)
                yield cut(whole.slice(0, block))
                held, n = whole.slice(block).to_batches(), n - block
        if n:
            yield cut(pa.Table.from_batches(held))

    schema = f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, trees array<struct<{TREE}>>"
    return rows.mapInArrow(build, schema)


def learned(built: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: the codebooks after every part went to its nearest entry."""
    parts, size, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, size, width + 1), np.int64)
        for batch in batches:
            for trees in batch.column(0):
                for p, packed in enumerate(trees):
                    total[p] += owned_sums(Tree.unpack(packed.as_py(), width), books[p])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size)), pa.array(total.ravel())], ["place", "total"]
        )

    each = built.select("trees").mapInArrow(add, "place long, total long")
    # One row per component of an entry, whatever the number of vectors.
    sums = each.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    total = np.zeros(parts * size * (width + 1), object)
    for row in sums.collect():
        total[row["place"]] = int(row["total"])
    total = total.reshape(parts, size, width + 1)
    counts = total[:, :, -1:]
    used = counts > 0
    return np.where(used, total[:, :, :-1] // np.where(used, counts, 1), books).astype(np.int64)


def coded(built: DataFrame, books: np.ndarray) -> DataFrame:
    """``id, label, code, error`` of every row of the blocks."""
    parts, _, width = books.shape
    kinds = {f.name: f.dataType.elementType for f in built.schema if f.name in ("ids", "labels")}

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, trees in enumerate(batch.column("trees")):
                found = [
                    assigned(Tree.unpack(packed.as_py(), width), books[p])
                    for p, packed in enumerate(trees)
                ]
                codes = np.stack([entry for entry, _ in found], axis=1)
                digits = codes.astype(">u1" if books.shape[1] <= 256 else ">u2").tobytes()
                n = len(digits) // len(codes)
                text = [digits[j : j + n].hex() for j in range(0, len(digits), n)]
                error = np.sum([error for _, error in found], axis=0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c)[i].values for c in ("ids", "labels")]
                    + [pa.array(text), pa.array(error)],
                    ["id", "label", "code", "error"],
                )

    schema = ", ".join(f"{n} {kinds[k].simpleString()}" for n, k in (("id", "ids"), ("label", "labels")))
    return built.mapInArrow(code, f"{schema}, code string, error long")


def compress(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every vector, and the
    codebooks (part, entry, component).

    Components are ``floor(256 * x)``. A codebook begins as the parts of the first ``entries``
    vectors by id. ``code`` holds two hex digits per part (four with more than 256 entries),
    ``error`` the squared distance to the code, ``label_error`` its sum over a label.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    rows = df.select(
        F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector")
    ).where((F.size("vector") > 0) & finite)
    first = rows.select("id", "vector").orderBy(F.asc_nulls_last("id"), "vector").limit(entries)
    seeds = [r["vector"] for r in first.collect()]
    length = len(seeds[0]) if seeds else parts
    if length % parts or any(len(s) != length for s in seeds):
        raise ValueError(f"vectors cannot be cut into {parts} equal parts")
    width = length // parts
    start = pa.array(seeds, pa.list_(pa.float64()))
    books = _codebook(_whole(start, parts, width), parts)
    built = staged(blocks(rows, parts, width), "trees")
    for _ in range(rounds if seeds else 0):
        books = learned(built, books)
    codes = staged(coded(built, books), "codes")
    # A struct is equal to one that also holds a null.
    keyed = codes.withColumns({"key": F.struct("label"), "row": F.monotonically_increasing_id()})
    totals = keyed.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    joined = join_counted(keyed, totals, "key", "n", F.col("row"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    result = joined.select(
        F.col("id").alias(vec_id),
        F.col("label").alias(label),
        "code",
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )
    return result, books
