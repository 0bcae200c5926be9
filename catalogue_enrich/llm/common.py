"""What the operators on training data share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession

from ..session import ROW_GROUPS, shared_folder

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: work is done once, and a lost
    executor costs nothing that was finished."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.options(**ROW_GROUPS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of few rows for the Python functions of what is run inside: a row may hold a whole
    text or set, and a batch is held on both sides."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, rows)
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def once(function: Callable[..., Column]) -> Callable[..., Column]:
    """A Python function that is run once per row, even where its result is both filtered by and
    selected: the optimizer makes two of one that it takes for deterministic."""
    return function.asNondeterministic()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
