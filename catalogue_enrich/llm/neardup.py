"""Near duplicates by an LSH forest of min-hash signatures.

Texts with the same set of shingles are one class. A signature of each class is read in several
orders (trees). In a tree the classes that share the first ``depth`` prints are a region; sorted
by the whole order, neighbours share the longest prefixes, so where a region is dense candidates
are found deep in the tree and where it is thin at its least depth.

Candidates are classes of a region whose signatures agree well enough. They are confirmed on the
full sets, in two rounds. The first takes, of the neighbours along the order, the best few of
each class; its links make components. The second takes every pair of a region that could join
two components, where it meets, so no candidate that could change the result is left out, while
pairs are no rows and a group of thousands of copies does not confirm all of them.

A region too large for one task is walked by the first round in pieces: by twice the prefix, and
what is still too large by parts that differ from tree to tree. That only makes its links fewer.
The second round cuts such a region, at its least depth, into blocks of rows and compares every
block with every other in a task of its own, except blocks that hold one and the same component.
Its work grows with the square of the rows that the first round left in many small components.

Least depth: the largest at which a pair at the threshold shares a region in some tree but for
two cases in 100,000.

Defined results: a null or empty text has no shingles and is alone; a text of fewer words than a
shingle is one shingle; a null key is like any other, but a component's id is its least key that
is not null; repeated rows are one class. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import once, small_batches, staged
from .components import components
from .shingles import MinHash, set_id, shingle_set

TREES, PRINTS, ORDER = 16, 128, 16
# Rows of a region that one task compares.
REGION = 4096
# How far along the order a class is compared, and how many links it is offered at first.
WINDOW, FIRST = 16, 2
# By how many standard deviations of an estimate a candidate may fall short.
SLACK = 4.0
# Rows of a batch of texts or pairs of sets.
BATCH = 1000
# Pairs of signatures compared at once.
COMPARED = 1 << 14

SKETCH = pa.struct([("n", pa.int64()), ("set_id", pa.binary()), ("prints", pa.binary())])
SKETCH_DDL = "n long, set_id binary, prints binary"
PAIR = "a binary, b binary, agreed int"


def least_depth(threshold: float) -> int:
    depth = 1
    while (1 - threshold ** (depth + 1)) ** TREES <= 2e-5:
        depth += 1
    return depth


def _bytes(texts: pa.Array) -> Iterator[bytes]:
    for text in texts:
        yield memoryview(text.as_buffer()).tobytes() if text.is_valid else b""


def sketches(documents: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``key, print, n, set_id, prints`` of every document; ``print`` is a hash of its text."""

    def sketch(texts: pa.Array) -> pa.Array:
        minhash, rows = MinHash(PRINTS), []
        for data in _bytes(texts):
            own = shingle_set(data, width)
            if len(own):
                rows.append((len(own), set_id(own), minhash(own).astype(">u2").tobytes()))
            else:
                rows.append((0, None, None))
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, SKETCH, strict=True)]
        return pa.StructArray.from_arrays(arrays, SKETCH.names)

    made = F.arrow_udf(sketch, SKETCH_DDL)(F.col(text).cast("string"))
    print_ = F.xxhash64(F.col(text).cast("string")).alias("print")
    rows = documents.select(F.col(key).alias("key"), print_, made.alias("s"))
    return rows.select("key", "print", "s.*")


def _prefix(tree: int, depth: int) -> Column:
    """Hash of the first ``depth`` prints of an order: the signature, begun anew at a place."""
    return F.xxhash64(F.lit(tree), F.lit(depth), _order(tree, depth))


def _order(tree: int, depth: int) -> Column:
    begin = tree * PRINTS // TREES
    turned = F.concat(F.col("prints"), F.substring("prints", 1, 2 * ORDER))
    return F.substring(turned, 2 * begin + 1, 2 * depth)


def regions(classes: DataFrame, depth: int) -> DataFrame:
    """``region, walk, large, tree, set_id, n, prints`` of classes that share a region with
    another; ``walk`` is the piece of a region that the first round takes, null if a class is
    alone in it, and ``large`` tells of a region too large for a task."""
    deep = min(ORDER, 2 * depth)
    trees = F.array(
        *[
            F.struct(
                F.lit(t).alias("tree"),
                _prefix(t, depth).alias("near"),
                _prefix(t, deep).alias("far"),
            )
            for t in range(TREES)
        ]
    )
    rows = staged(classes.select("set_id", F.inline(trees)), "trees")
    near = rows.groupBy("near").agg(F.count("*").alias("n_near")).where("n_near > 1")
    rows = rows.join(near, "near")
    # Only regions too large for a task are counted deeper.
    far = (
        rows.where(F.col("n_near") > REGION)
        .groupBy("far")
        .agg(F.count("*").alias("n_far"))
        .where("n_far > 1")
    )
    rows = rows.join(far, "far", "left")
    large = F.col("n_near") > REGION
    part = F.pmod(F.xxhash64("set_id", "tree"), F.ceil(F.col("n_far") / REGION))
    walk = (
        F.when(~large, F.col("near"))
        .when(F.col("n_far") <= REGION, F.col("far"))
        .when(F.col("n_far") > REGION, F.xxhash64("far", part))
    )
    crowded = rows.select(
        F.col("near").alias("region"), walk.alias("walk"), large.alias("large"), "tree", "set_id"
    )
    return crowded.join(classes.select("set_id", "n", "prints"), "set_id")


def blocks(rows: DataFrame) -> DataFrame:
    """``rows`` (``region, label`` and others) of large regions, once for each block that theirs is
    to be compared with: ``region`` is then the two blocks' own, ``block`` tells them apart.

    A block is half of ``REGION`` rows. Labels of so many rows have blocks of their own, which are
    not compared with each other; all other rows of a region share the rest.
    """
    half = max(1, REGION // 2)
    sizes = rows.groupBy("region", "label").agg(F.count("*").alias("size"))
    pure = F.when(F.col("size") >= half, F.col("label")).alias("pure")
    sizes = sizes.groupBy("region", pure).agg(F.ceil(F.sum("size") / half).alias("parts"))
    # A region has no more of these than blocks.
    family = Window.partitionBy("region")
    before = family.orderBy("pure").rowsBetween(Window.unboundedPreceding, -1)
    numbered = staged(
        sizes.select(
            F.col("region").alias("of"),
            "pure",
            "parts",
            F.coalesce(F.sum("parts").over(before), F.lit(0)).alias("first"),
            F.sum("parts").over(family).alias("all"),
        ),
        "blocks",
    )
    own = numbered.where("pure is not null")
    rest = numbered.where("pure is null")
    fields = ["pure", "parts", "first", "all"]
    own = own.select("of", "pure", F.struct(*fields).alias("own"))
    rest = rest.select(F.col("of").alias("at"), F.struct(*fields).alias("rest"))
    placed = (
        rows.join(own, (F.col("region") == F.col("of")) & (F.col("label") == F.col("pure")), "left")
        .join(rest, F.col("region") == F.col("at"), "left")
        .withColumn("is", F.coalesce("own", "rest"))
    )
    block = F.col("is.first") + F.pmod(F.xxhash64("set_id", "tree"), F.col("is.parts"))
    placed = placed.withColumn("block", block.cast("int")).select(
        "*", F.explode(F.expr("sequence(0L, is.all - 1)")).alias("other")
    )
    last = F.col("is.first") + F.col("is.parts")
    alike = F.col("is.pure").isNotNull() & (F.col("other") >= F.col("is.first"))
    placed = placed.where(~(alike & (F.col("other") < last)))
    pair = F.least("block", "other"), F.greatest("block", "other")
    region = F.xxhash64("region", *pair)
    return placed.select(*[region.alias(c) if c == "region" else c for c in rows.columns], "block")


def _signatures(batch: pa.RecordBatch) -> np.ndarray:
    data = b"".join(batch.column("prints").to_pylist())
    return np.frombuffer(data, np.uint16).reshape(batch.num_rows, -1)


def _alike(
    prints: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray, needed: float, least: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs whose sizes and signatures allow a link, with which of the prints agree."""
    small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
    ok = small >= least * large
    i, j = i[ok], j[ok]
    agree = prints[i] == prints[j]
    ok = agree.sum(axis=1) >= needed
    return i[ok], j[ok], agree[ok]


def _pairs(batch: pa.RecordBatch, i: np.ndarray, j: np.ndarray, agreed: np.ndarray):
    ids = np.array(batch.column("set_id").to_pylist(), object)
    a, b = ids[i], ids[j]
    swap = a > b
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    columns = [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(agreed)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "agreed"])


def _neighbours(
    batches: Iterator[pa.RecordBatch], needed: float, least: float
) -> Iterator[pa.RecordBatch]:
    """Pairs of rows near each other in the order of a region, from rows sorted by it, that are
    among the ``FIRST`` best ones of one of the two."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        n, old = batch.num_rows, 0 if held is None else held.num_rows
        region, prints = batch.column("region").to_numpy(), _signatures(batch)
        sizes, found = batch.column("n").to_numpy(), []
        for lag in range(1, min(WINDOW, n - 1) + 1):
            # Rows held from the batch before were compared with each other already.
            i = np.arange(max(0, old - lag), n - lag)
            i = i[region[i] == region[i + lag]]
            if not len(i):
                break
            i, j, agree = _alike(prints, sizes, i, i + lag, needed, least)
            found.append((i, j, agree.sum(axis=1).astype(np.int32)))
        if found and sum(len(f[0]) for f in found):
            i, j, agreed = map(np.concatenate, zip(*found, strict=True))
            chosen = np.zeros(len(i), bool)
            for end in (i, j):
                order = np.lexsort((-agreed, end))
                new = np.r_[True, end[order][1:] != end[order][:-1]]
                rank = np.arange(len(i)) - np.flatnonzero(new)[np.cumsum(new) - 1]
                chosen[order[rank < FIRST]] = True
            yield _pairs(batch, i[chosen], j[chosen], agreed[chosen])
        held = batch.slice(max(0, n - WINDOW))


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut anew between regions, from rows sorted by region."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        region = batch.column("region").to_numpy()
        ends = np.flatnonzero(region[1:] != region[:-1]) + 1
        if held and len(region) and region[0] != held[-1].column("region")[-1].as_py():
            yield pa.concat_batches(held)
            held = []
        if len(ends):
            yield pa.concat_batches([*held, batch.slice(0, ends[-1])])
            held = []
            batch = batch.slice(ends[-1])
        if batch.num_rows:
            held.append(batch)
    if held:
        yield pa.concat_batches(held)


def _meetings(
    batch: pa.RecordBatch, needed: float, least: float, depth: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a region that may be linked and have different labels, in parts.

    A pair that meets in several trees is given in the first of them. The rows of the commonest
    label are not compared with each other, nor, where there are two blocks, those of one block.
    """
    region, prints = batch.column("region").to_numpy(), _signatures(batch)
    sizes, trees = batch.column("n").to_numpy(), batch.column("tree").to_numpy()
    blocks = batch.column("block").to_numpy()
    labels = np.array(batch.column("label").to_pylist(), object)
    labels = np.unique(labels, return_inverse=True)[1]
    cuts = np.r_[0, np.flatnonzero(region[1:] != region[:-1]) + 1, len(region)]
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        own, block = labels[begin:end], blocks[begin:end]
        single = block.min() == block.max()
        common = np.bincount(own - own.min()).argmax() + own.min()
        rare = np.flatnonzero(own != common)
        step = max(1, COMPARED // (end - begin))
        for part in range(0, len(rare), step):
            i = np.repeat(rare[part : part + step], end - begin)
            j = np.tile(np.arange(end - begin), len(i) // (end - begin))
            # Of two rare rows the earlier is compared with the later only.
            ok = (own[i] != own[j]) & ((own[j] == common) | (i < j))
            ok &= single | (block[i] != block[j])
            i, j, agree = _alike(prints, sizes, i[ok] + begin, j[ok] + begin, needed, least)
            if len(i):
                by_tree = agree.reshape(len(i), TREES, -1)[:, :, :depth].all(axis=2)
                ok = by_tree.argmax(axis=1) == trees[i]
                yield i[ok], j[ok]


def _wanted(
    batches: Iterator[pa.RecordBatch], needed: float, least: float, depth: int
) -> Iterator[pa.RecordBatch]:
    """The rows that have a partner in their region."""
    for batch in _whole(batches):
        wanted = np.zeros(batch.num_rows, bool)
        for i, j in _meetings(batch, needed, least, depth):
            wanted[i] = wanted[j] = True
        yield batch.filter(pa.array(wanted))


def _linked(
    batches: Iterator[pa.RecordBatch], needed: float, least: float, depth: int, percent: int
) -> Iterator[pa.RecordBatch]:
    """Links between rows of a region, by their full sets; of those that join the same rows, or
    rows of the same labels, the first found is enough."""
    for batch in _whole(batches):
        labels = batch.column("label").to_pylist()
        parent = {label: label for label in labels}

        def root(label: bytes, parent: dict[bytes, bytes] = parent) -> bytes:
            while parent[label] != label:
                parent[label] = label = parent[parent[label]]
            return label

        sets, found = batch.column("shingles"), []
        for rows in _meetings(batch, needed, least, depth):
            for i, j in zip(*(r.tolist() for r in rows), strict=True):
                a, b = root(labels[i]), root(labels[j])
                if a != b and _similar(sets[i].as_py(), sets[j].as_py(), percent):
                    parent[a] = b
                    found.append((i, j))
        if found:
            ids = batch.column("set_id").to_pylist()
            a, b = zip(*((ids[i], ids[j]) for i, j in found), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"]
            )


def _similar(a: bytes, b: bytes, percent: int) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def needed_prints(threshold: float) -> float:
    """Prints that must agree for a pair to be a candidate."""
    spread = (PRINTS * threshold * (1 - threshold)) ** 0.5
    return PRINTS * threshold - SLACK * spread


def candidates(crowded: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs ``a, b, agreed`` of set ids: the best neighbours in the orders."""
    needed = needed_prints(threshold)
    order = F.lit(b"")
    for tree in range(TREES):
        order = F.when(F.col("tree") == tree, _order(tree, ORDER)).otherwise(order)
    walked = crowded.where("walk is not null")
    rows = walked.select(
        F.col("walk").alias("region"), "prints", "set_id", "n", order.alias("order")
    )
    rows = _dealt(rows).sortWithinPartitions("region", "order", "set_id")
    pairs = rows.drop("order").mapInArrow(lambda b: _neighbours(b, needed, threshold), PAIR)
    return pairs.groupBy("a", "b").agg(F.max("agreed").alias("agreed"))


def joining(crowded: DataFrame, threshold: float, labels: DataFrame) -> DataFrame:
    """``region, tree, set_id, n, prints, label, block`` of the rows that have a possible link to
    a row of another component (``labels``: ``node, component``) in their region."""
    needed, depth = needed_prints(threshold), least_depth(threshold)
    rows = crowded.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    rows = rows.withColumn("label", F.coalesce("component", "set_id")).drop("component")
    # Regions of one component have nothing more to find.
    mixed = rows.groupBy("region").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    rows = rows.join(mixed.where("x <> y").select("region"), "region")
    own = ["region", "tree", "set_id", "n", "prints", "label"]
    # Most tables have no region too large for a task.
    if crowded.where("large").isEmpty():
        rows = rows.select(*own, F.lit(0).alias("block"))
    else:
        large = staged(rows.where("large").select(own), "large")
        rows = rows.where("not large").select(*own, F.lit(0).alias("block")).union(blocks(large))
    return _dealt(rows).sortWithinPartitions("region").mapInArrow(
        lambda b: _wanted(b, needed, threshold, depth), rows.schema
    )


def joined(rows: DataFrame, sets: DataFrame, threshold: float, percent: int) -> DataFrame:
    """Links ``a, b`` between the rows of ``joining``, confirmed where they meet: a pair is never
    a row, however many there are, and every set travels once per region."""
    needed, depth = needed_prints(threshold), least_depth(threshold)
    own = [*rows.columns, "shingles"]
    rows = _dealt(rows.join(sets, "set_id").select(own)).sortWithinPartitions("region")
    return rows.mapInArrow(
        lambda b: _linked(b, needed, threshold, depth, percent), "a binary, b binary"
    )


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of a region together.

    By an expression of the region: a shuffle by the region alone would be taken for that of a
    join before it, which may turn into a broadcast whose reader does not keep regions whole.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, F.xxhash64("region"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets (``set_id, shingles``) are alike enough."""

    def alike(a: pa.Array, b: pa.Array) -> pa.Array:
        pairs = zip(a.to_pylist(), b.to_pylist(), strict=True)
        return pa.array([_similar(x, y, percent) for x, y in pairs], pa.bool_())

    left = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.where(F.arrow_udf(alike, "boolean")("of_a", "of_b")).select("a", "b")


def full_sets(
    documents: DataFrame, key: str, text: str, width: int, wanted: DataFrame
) -> DataFrame:
    """``set_id, shingles`` of the classes ``wanted`` (``set_id, rep``), from their texts."""

    def shingled(texts: pa.Array) -> pa.Array:
        sets = [shingle_set(data, width) for data in _bytes(texts)]
        ids = pa.array([set_id(s) if len(s) else None for s in sets], pa.binary())
        data = pa.array([s.tobytes() for s in sets], pa.binary())
        return pa.StructArray.from_arrays([ids, data], ["found", "shingles"])

    texts = documents.select(F.col(key).alias("rep"), F.col(text).cast("string").alias("text"))
    rows = texts.join(wanted, texts["rep"].eqNullSafe(wanted["rep"])).select(
        "set_id", once(F.arrow_udf(shingled, "found binary, shingles binary"))("text").alias("s")
    )
    # Rows that share their key with the one that is meant have other sets.
    rows = rows.where("s.found = set_id").select("set_id", "s.shingles")
    return staged(rows.dropDuplicates(["set_id"]), "sets")


def forest_components(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Per document ``key, n_shingles, component_id, kept``: documents whose shingle sets have a
    Jaccard similarity of ``percent`` / 100 or more are linked, and a component's id is the least
    key reachable over links."""
    with small_batches(documents.sparkSession, BATCH):
        rows = _components(documents, key, text, width, percent)
    return rows.select(F.col("key").alias(key), "n_shingles", "component_id", "kept")


def without_near_duplicates(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``documents`` with one row of each component, that of the least key; of rows equal in key
    and text one stays, of documents without words each."""
    with small_batches(documents.sparkSession, BATCH):
        rows = _components(documents, key, text, width, percent)
    rows = rows.where("kept").select(F.col("key").alias("k"), F.col("print").alias("p")).distinct()
    own = documents.columns
    marked = documents.select(
        F.struct(*own).alias("row"),
        F.col(key).alias("key"),
        F.xxhash64(F.col(text).cast("string")).alias("print"),
    )
    kept = marked.join(
        rows, marked["key"].eqNullSafe(rows["k"]) & (marked["print"] == rows["p"]), "left_semi"
    )
    alike = Window.partitionBy("key", "print").orderBy(F.xxhash64("row"))
    first = kept.withColumn("rank", F.row_number().over(alike)).where("rank = 1")
    return first.select("row.*")


def _components(
    documents: DataFrame, key: str, text: str, width: int, percent: int
) -> DataFrame:
    threshold = percent / 100
    sketched = staged(sketches(documents, key, text, width), "sketches")
    classes = (
        sketched.where("n > 0")
        .groupBy("set_id")
        .agg(F.min("key").alias("rep"), F.first("n").alias("n"), F.first("prints").alias("prints"))
    )
    classes = staged(classes, "classes")
    crowded = staged(regions(classes, least_depth(threshold)), "regions")

    reps = classes.select("set_id", "rep")
    pairs = staged(candidates(crowded, threshold), "candidates")
    # Of the trees' offers a class takes the best ones again.
    best = _best(pairs)
    ends = _ends(pairs)
    sets = full_sets(documents, key, text, width, ends.join(reps, "set_id"))
    links = staged(confirmed(best, sets, percent), "confirmed")
    labels = staged(components(links), "labels")

    rows = staged(joining(crowded, threshold, labels), "joining")
    if not rows.isEmpty():
        met = rows.select("set_id").distinct()
        new = staged(met.join(ends, "set_id", "left_anti").join(reps, "set_id"), "ends")
        if not new.isEmpty():
            sets = sets.union(full_sets(documents, key, text, width, new))
        links = links.union(staged(joined(rows, sets, threshold, percent), "joined"))
        labels = staged(components(links), "labels")

    named = classes.select("set_id", "rep").join(
        labels, F.col("set_id") == F.col("node"), "left"
    )
    named = named.withColumn("component", F.coalesce("component", "set_id"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").select("set_id", "component_id")
    result = sketched.join(named, "set_id", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    return result.select(
        "key",
        "print",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"),
    )


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()


def _best(pairs: DataFrame) -> DataFrame:
    """Pairs that are among the ``FIRST`` best of one of their ends."""
    ends = F.array(
        F.struct(F.col("a").alias("end"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("end"), F.col("a").alias("other")),
    )
    rows = pairs.select("a", "b", "agreed", F.inline(ends))
    best = Window.partitionBy("end").orderBy(F.desc("agreed"), "other")
    ranked = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= FIRST)
    return staged(ranked.select("a", "b").distinct(), "best")
