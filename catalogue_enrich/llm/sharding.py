"""Sharding: a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at many places of a ring; a key belongs to the first place clockwise of its
own hash. A shard takes rows up to its bound; keys that find it full continue clockwise to the
next other shard. With bounds that add up to all rows every shard is filled exactly, so counts
are at most one apart; with ``slack`` fewer keys move on and a new shard disturbs less.

All keys of one arc (between two places) meet the shards in the same order, so who goes where is
settled by how many rows each arc has. These numbers, one per place and bounded by the
parameters, are all that the driver sees; it returns intervals of ranks within arcs. Rows get
their rank from counts per part of an arc, where a part is a share of the input's rows, so not
even rows that are all alike meet in one task.

Places are numbers of 63 bits, so any number of shards has places of its own. Rows find their arc
by the cell that the first bits of their place name, and by its bounds in that cell.

Defined results: a null key is a key; equal rows are placed each by itself; an empty table gives
no rows. Rows are written once before they are ranked, so a task that runs again ranks alike.
"""

from __future__ import annotations

from array import array

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged

# Equal parts of the ring, which rows look their arc up by.
CELLS = 1 << 14
CELL_BITS = 63 - 14
# Shares that the rows of an arc are ranked in.
PARTS = 256


def position(seed: int, *what: Column | str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *what), 1)


def ring(spark: SparkSession, shards: int, replicas: int, seed: int) -> list[tuple[int, int]]:
    """Places in clockwise order, as position and shard; where a shard stands does not depend on
    how many there are."""
    nodes = spark.range(shards * replicas).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        F.floor(F.col("id") / shards).alias("replica"),
    )
    rows = nodes.select(position(seed, F.lit("place"), "shard", "replica"), "shard").collect()
    return sorted((at, shard) for at, shard in rows)


def arcs_of(places: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """Cell, least and greatest position there, and arc; every position lies in one.

    An arc ends at its place, and past the last place the first arc begins.
    """
    out, start = [], 0
    stops = [at for at, _ in places] + [(1 << 63) - 1]
    for arc, stop in enumerate(stops):
        for cell in range(start >> CELL_BITS, (stop >> CELL_BITS) + 1 if start <= stop else 0):
            first = max(start, cell << CELL_BITS)
            last = min(stop, ((cell + 1) << CELL_BITS) - 1)
            out.append((cell, first, last, arc % len(places)))
        start = stop + 1
    return out


def orders(places: list[tuple[int, int]]) -> list[array]:
    """For each place the shards in the order in which they are met from there.

    Going back by one place brings its shard to the front.
    """
    order = list(dict.fromkeys(shard for _, shard in places))
    out = []
    for _, shard in reversed(places):
        order.remove(shard)
        order.insert(0, shard)
        out.append(array("i", order))
    return out[::-1]


def settle(
    places: list[tuple[int, int]], counts: list[int], bounds: list[int]
) -> list[tuple[int, int, int, int, int]]:
    """Intervals ``(arc, first rank, rank after the last, shard, first slot)``.

    In round r the rows still on their way in an arc knock at the r-th shard they meet, arc by
    arc, clockwise; it takes as many as its bound leaves room for.
    """
    waiting = [0] * len(counts)  # rank of the first row of an arc that has no shard
    room, filled, out = list(bounds), [0] * len(bounds), []
    met = orders(places)
    left = [arc for arc, n in enumerate(counts) if n]
    for step in range(len(bounds)):
        for arc in left:
            shard = met[arc][step]
            if n := min(counts[arc] - waiting[arc], room[shard]):
                out.append((arc, waiting[arc], waiting[arc] + n, shard, filled[shard]))
                waiting[arc] += n
                room[shard] -= n
                filled[shard] += n
        left = [arc for arc in left if waiting[arc] < counts[arc]]
    return out


def place(
    rows: DataFrame,
    key: str,
    shards: int,
    replicas: int = 64,
    slack: float = 0.0,
    seed: int = 7,
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 within a shard).

    Columns of the input with these names are dropped.
    """
    spark = rows.sparkSession
    own = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    places = ring(spark, shards, replicas, seed)
    # At most CELLS + shards x replicas rows.
    arcs = F.broadcast(
        spark.createDataFrame(arcs_of(places), "cell int, first long, last long, arc int")
    )
    # Every share has rows of every input partition, whatever they hold.
    number = F.pmod(F.monotonically_increasing_id(), F.lit(PARTS))
    keyed = rows.select(
        F.struct(*own).alias("row"),
        F.struct(F.xxhash64(F.struct(key)).alias("hash"), key).alias("order"),
        position(seed, F.lit("key"), F.struct(key)).alias("at"),
        number.cast("int").alias("part"),
    )
    keyed = keyed.withColumn("cell", F.shiftright("at", CELL_BITS).cast("int")).join(arcs, "cell")
    keyed = keyed.where("at between first and last").drop("cell", "at", "first", "last")
    keyed = staged(keyed, "ring")

    counts = keyed.groupBy("arc", "part").agg(F.count("*").alias("n"))
    totals = [0] * len(places)
    for r in counts.groupBy("arc").agg(F.sum("n").alias("n")).collect():
        totals[r["arc"]] = r["n"]
    n = sum(totals)
    if slack:
        bounds = [int(-(-n * (1 + slack) // shards))] * shards
    else:
        bounds = [n // shards + (s < n % shards) for s in range(shards)]
    taken = settle(places, totals, bounds)

    before = Window.partitionBy("arc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "arc", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    # The order within a part is that of the key; rows alike may take each other's slot.
    within = Window.partitionBy("arc", "part").orderBy("order")
    ranked = keyed.withColumn("own", F.row_number().over(within)).join(offsets, ["arc", "part"])
    ranked = ranked.select("row", "arc", (F.col("before") + F.col("own") - 1).alias("rank"))
    # At most places x shards rows.
    intervals = spark.createDataFrame(taken, "arc int, first long, stop long, shard int, slot long")
    placed = ranked.join(F.broadcast(intervals), "arc").where("rank >= first and rank < stop")
    return placed.select(
        "row.*", "shard", (F.col("slot") + F.col("rank") - F.col("first")).alias("slot")
    )
