"""Connected components of a graph of links, by stars around least neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``links`` (``a, b``); a component is its least node.

    In a round every node hangs itself and its neighbours on the least of them, which keeps what
    is connected connected and about halves the way to the least node; links that no longer
    change are stars. The least neighbours are combined before they are shuffled, so a node with
    very many links costs a row per task, and the join that follows may be split by Spark. Every
    round is written down: no lineage to run again.
    """
    edges = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    edges = staged(edges.where("v <> u").distinct(), "links")
    state = None
    while (new := _state(edges)) != state:
        state = new
        ends = F.array(
            F.struct(F.col("v").alias("node"), F.col("u").alias("other")),
            F.struct(F.col("u").alias("node"), F.col("v").alias("other")),
        )
        both = edges.select(F.inline(ends))
        least = both.groupBy("node").agg(F.min("other").alias("least"))
        least = least.select("node", F.least("node", "least").alias("least"))
        hung = both.join(least, "node").select(
            F.explode(
                F.array(
                    F.struct(F.col("other").alias("v"), F.col("least").alias("u")),
                    F.struct(F.col("node").alias("v"), F.col("least").alias("u")),
                )
            ).alias("e")
        )
        hung = hung.select("e.v", "e.u").where("v <> u")
        # The least of a node's neighbourhood may be larger than a neighbour hung on it.
        hung = hung.select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u"))
        edges = staged(hung.distinct(), "links")
    roots = edges.select(F.col("u").alias("node")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )


def _state(edges: DataFrame) -> tuple:
    """What tells whether a round has changed anything."""
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    )
