"""Bounded batches over a listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder


def assign_batches(files: DataFrame, order_by: str, batch_size: int) -> DataFrame:
    """Add ``batch``: rows in ``order_by`` order, ``batch_size`` per batch, counted from 0.

    A global ``row_number()`` would pull the listing through one task. The listing is
    range-partitioned instead; each partition numbers its own rows and is shifted by the
    row count of the partitions before it. Only those counts (one row per partition) meet
    in one task, and only they are broadcast. Rows of equal keys have no order, so they may
    be split over partitions too.
    """
    spark = files.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoints"))
    # Checkpointed, so a lost executor cannot renumber part of the rows.
    placed = (
        files.withColumn("_tie", F.rand(seed=0))
        .repartitionByRange(order_by, "_tie")
        .sortWithinPartitions(order_by)
        .drop("_tie")
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_row", F.col("_id").bitwiseAND((1 << 33) - 1))
        .drop("_id")
    )
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    number = F.col("_offset") + F.col("_row")
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("batch", F.floor(number / batch_size).cast("bigint"))
        .drop("_part", "_row", "_offset")
    )


def batch_report(batched: DataFrame, batch_size: int) -> DataFrame:
    """``batch, n, more_available``: a full batch means that more may be waiting."""
    return batched.groupBy("batch").agg(
        F.count("*").alias("n"), (F.count("*") == batch_size).alias("more_available")
    )
