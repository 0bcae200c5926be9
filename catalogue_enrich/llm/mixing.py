"""Mixing sources to target weights: hierarchical budgeting.

Documents are the leaves' contents of a tree (such as domain, language, source); every node has
a weight among its siblings. The budget of tokens flows down the tree: children share their
parent's budget by weight, a child takes no more than its subtree can supply (its tokens times
``max_epochs``), and what a child cannot use is shared by its siblings, by weight; only what a
whole family cannot use goes to the family's own siblings. A leaf is then filled by whole epochs
and, from one more epoch in an order given by the seed, the longest prefix of whole documents
that fits.

The budget is settled on one row per leaf. A prefix needs no sorted leaf: documents fall into
buckets of their hash, sums per bucket tell in which bucket the prefix ends, and only that one is
sorted. A leaf of a third of all rows is thus spread over as many buckets as its size asks for.

Defined results: null level values are a node of their own; a document without tokens belongs to
the prefix if its place in the order does; rows alike are documents each; a leaf without weight
gets nothing; budgets are rounded down, so a family may miss its budget by fewer tokens than it
has members. Leaves may be as many as the documents: only those that hold ``1 / HOT`` of all rows
are sent to every task, all others meet their documents by key. ``max_leaves`` refuses more, if
the caller knows how many there should be.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, staged

BUCKET_ROWS = 1000
# A leaf of this part of all rows is hot.
HOT = 256
_BITS = 52  # of the hash; 13 hexadecimal digits


def word_count(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(r"[^ \t-\r]+"))


def _path(levels: list[str], depth: int) -> Column:
    """The node of a row at ``depth``: a JSON array, so nulls and any text stay distinct."""
    return F.to_json(F.array(*[F.col(c).cast("string") for c in levels[:depth]]))


def seeded(seed: int, epoch: Column, key: str) -> Column:
    """A number of ``_BITS`` bits from seed, epoch and a document's key."""
    text = F.concat_ws(":", F.lit(seed), epoch, F.coalesce(F.col(key).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, _BITS // 4), 16, 10).cast("long")


def share(nodes: DataFrame) -> DataFrame:
    """Budgets of siblings: ``nodes`` (``parent, node, supply, weight, budget``, the last that
    of the parent) with ``granted``.

    Children are ordered by how soon they are satisfied. The first that its share does not
    satisfy sets the level at which it and all later ones share what is left.
    """
    ahead = Window.partitionBy("parent").orderBy(F.col("supply") / F.col("weight"), "node")
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    family = Window.partitionBy("parent")
    wide = "decimal(38,0)"

    def earlier(column: str) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    live = nodes.where("weight > 0").select(
        "*",
        F.greatest(F.col("budget") - earlier("supply"), F.lit(0)).alias("left"),
        (F.sum("weight").over(family) - earlier("weight")).alias("claims"),
    )
    satisfied = F.col("supply").cast(wide) * F.col("claims").cast(wide) <= F.col("left").cast(
        wide
    ) * F.col("weight").cast(wide)
    first = F.min_by(F.struct("left", "claims"), F.struct(F.col("supply") / F.col("weight"), "node"))
    live = live.withColumn("satisfied", satisfied)
    levels = live.where(~F.col("satisfied")).groupBy("parent").agg(first.alias("level"))
    part = F.expr(
        "(cast(level.left as decimal(38,0)) * cast(weight as decimal(38,0))) "
        "div cast(level.claims as decimal(38,0))"
    )
    return live.join(levels, "parent", "left").select(
        "parent",
        "node",
        "supply",
        F.when(F.col("satisfied"), F.col("supply")).otherwise(part).alias("granted"),
    )


def budgets(
    leaves: DataFrame,
    depth: int,
    weights: Mapping[tuple, int],
    budget: int,
    max_epochs: int,
) -> DataFrame:
    """``leaf, granted`` from ``path1..path<depth>, tokens`` of each leaf."""
    spark = leaves.sparkSession
    named = [
        (json.dumps(list(path), separators=(",", ":"), ensure_ascii=False), int(weight))
        for path, weight in weights.items()
    ] or [("", 1)]
    # As many rows as weights are given.
    given = F.broadcast(spark.createDataFrame(named, "node string, weight long"))
    granted = None
    for level in range(1, depth + 1):
        parent = F.col(f"path{level - 1}") if level > 1 else F.lit("[]")
        nodes = leaves.groupBy(parent.alias("parent"), F.col(f"path{level}").alias("node")).agg(
            (F.sum("tokens") * max_epochs).alias("supply")
        )
        nodes = nodes.join(given, "node", "left").withColumn(
            "weight", F.coalesce("weight", F.lit(1)).cast("long")
        )
        if granted is None:
            nodes = nodes.withColumn("budget", F.lit(budget).cast("long"))
        else:
            above = granted.select(F.col("node").alias("parent"), F.col("granted").alias("budget"))
            nodes = nodes.join(above, "parent")
        granted = share(nodes)
    return granted.select(F.col("node").alias("leaf"), "granted")


def _planned(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with the ``plan`` of their leaf: there are at most ``HOT`` hot leaves, and no other
    has so many rows that one task could not take them."""
    hot = F.broadcast(plan.where("hot"))
    others = rows.join(hot.select("leaf"), "leaf", "left_anti")
    return rows.join(hot, "leaf").unionByName(others.join(plan.where("not hot"), "leaf"))


def mix(
    documents: DataFrame,
    levels: list[str],
    tokens: Column,
    key: str,
    weights: Mapping[tuple, int],
    budget_share: float = 1.0,
    budget: int | None = None,
    max_epochs: int = 4,
    seed: int = 11,
    max_leaves: int | None = None,
    result: str = "mix",
) -> tuple[DataFrame, str]:
    """The chosen rows of ``documents``, once per epoch, with a struct ``epoch, n_tokens`` and
    the name of that column.

    ``budget`` is in tokens; if it is not given it is ``budget_share`` of those there are.
    ``weights`` maps nodes, as tuples of level values from the root, to their weight among their
    siblings; it is 1 for all others.
    """
    depth = len(levels)
    name, own = free_name(documents, result), documents.columns
    n_tokens = F.coalesce(tokens, F.lit(0)).cast("long")
    keyed = documents.select(
        F.struct(*own).alias("row"),
        n_tokens.alias("tokens"),
        F.col(key).cast("string").alias("key"),
        *[_path(levels, d).alias(f"path{d}") for d in range(1, depth + 1)],
    )
    # Read three times below; tokens are counted once.
    keyed = staged(keyed, "mix").withColumnRenamed(f"path{depth}", "leaf")
    uppers = [f"path{d}" for d in range(1, depth)]
    leaves = staged(
        keyed.groupBy(*uppers, "leaf").agg(
            F.sum("tokens").alias("tokens"), F.count("*").alias("rows")
        ),
        "leaves",
    )
    n_leaves, total, n_rows = leaves.agg(F.count("*"), F.sum("tokens"), F.sum("rows")).first()
    if max_leaves is not None and n_leaves > max_leaves:
        raise ValueError(f"{n_leaves} leaves; a mix may have {max_leaves}")
    if budget is None:
        budget = int((total or 0) * budget_share)
    granted = budgets(
        leaves.withColumn(f"path{depth}", F.col("leaf")), depth, weights, budget, max_epochs
    )
    plan = leaves.join(granted, "leaf").select(
        "leaf",
        F.coalesce(F.expr("granted div nullif(tokens, 0)"), F.lit(0)).alias("whole"),
        F.expr("granted - coalesce(granted div nullif(tokens, 0), 0) * tokens").alias("rest"),
        F.greatest(F.lit(1), F.expr(f"rows div {BUCKET_ROWS}")).alias("buckets"),
        (F.col("rows") * HOT >= F.lit(n_rows or 0)).alias("hot"),
    )
    plan = staged(plan, "plan")
    hashed = F.shiftright(
        F.shiftright(seeded(seed, F.col("whole"), "key"), _BITS - 30) * F.col("buckets"), 30
    )
    placed = _planned(keyed, plan).withColumn("bucket", hashed)
    sums = placed.groupBy("leaf", "bucket").agg(
        F.sum("tokens").alias("tokens"), F.first("rest").alias("rest")
    )
    upto = Window.partitionBy("leaf").orderBy("bucket")
    ends = (
        sums.withColumn("after", F.sum("tokens").over(upto))
        .where("after > rest")
        .groupBy("leaf")
        .agg(F.min_by(F.struct("bucket", (F.col("after") - F.col("tokens")).alias("before")), "bucket").alias("last"))
    )
    # With the plan, so that documents meet both at once.
    ended = staged(plan.join(ends, "leaf", "left"), "ends")
    placed = _planned(keyed, ended).withColumn("bucket", hashed)
    inside = F.col("last").isNull() | (F.col("bucket") < F.col("last.bucket"))
    # A whole leaf that is not asked for again has no rest and no partial epoch.
    partial = F.col("rest") > 0
    epochs = F.when(partial & inside, F.col("whole") + 1).otherwise(F.col("whole"))
    repeated = placed.where(epochs > 0).select(
        "row", "tokens", F.explode(F.sequence(F.lit(0), (epochs - 1).cast("int"))).alias("epoch")
    )
    order = Window.partitionBy("leaf").orderBy(
        seeded(seed, F.col("whole"), "key"), "key", "tokens", F.xxhash64("row")
    )
    last = placed.where(partial & (F.col("bucket") == F.col("last.bucket")))
    ending = (
        last.withColumn("after", F.col("last.before") + F.sum("tokens").over(
            order.rowsBetween(Window.unboundedPreceding, 0)
        ))
        .where("after <= rest")
        .select("row", "tokens", F.col("whole").cast("int").alias("epoch"))
    )
    chosen = repeated.unionByName(ending)
    mixed = F.struct("epoch", F.col("tokens").alias("n_tokens")).alias(name)
    return chosen.select(*[F.col("row")[c].alias(c) for c in own], mixed), name
