"""Equi-join of a skewed side to a side with one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key's rows are spread so that no slice holds more than 1/SLICES of all rows.
SLICES = 256


def spread(
    many: DataFrame, one: DataFrame, key: str, n_uses: str, spread_by: Column, slices: int = SLICES
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_slice`` to join on beside ``key``.

    ``one`` has one row per key and, in ``n_uses``, the number of ``many`` rows of that
    key. A key with more than 1/``slices`` of all rows is hot; there are fewer than
    ``slices`` of them whatever the data, so the list of hot keys may be broadcast. Rows of
    a hot key are spread over slices by a hash of ``spread_by`` (stable, so a re-run task
    gives the same rows) and its ``one`` row is repeated per slice: at most 2 * ``slices``
    extra rows in all.
    """
    total = one.agg(F.sum(n_uses)).scalar()
    sliced = one.withColumn("_n", F.ceil(F.col(n_uses) * slices / total).cast("int"))
    hot = sliced.where(F.col("_n") > 1).select(key, "_n")
    n = F.coalesce("_n", F.lit(1))
    placed = many.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.pmod(F.xxhash64(spread_by), n).cast("int")
    )
    repeated = sliced.withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), F.greatest(F.col("_n"), F.lit(1)) - 1))
    )
    return placed.drop("_n"), repeated.drop("_n")


def join_counted(
    many: DataFrame, one: DataFrame, key: str, n_uses: str, spread_by: Column, slices: int = SLICES
) -> DataFrame:
    """Left join of ``many`` to ``one`` on ``key`` where a few keys may hold most rows."""
    placed, repeated = spread(many, one, key, n_uses, spread_by, slices)
    return placed.join(repeated, [key, "_slice"], "left").drop("_slice")
