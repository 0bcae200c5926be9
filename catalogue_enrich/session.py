"""Session settings and durable scratch space shared by all operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on; everything else is left to the caller.
REQUIRED_CONF = {
    # Option maps: the last duplicate id wins, as in a dict literal.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # JSON objects: the last duplicate key wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Data URLs must be one line.
    "spark.sql.chunkBase64String.enabled": "false",
    # A join whose smaller side proves small per partition need not sort the documents.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}

# Rows of staged tables hold images or whole documents. A reader holds up to one row group
# of them at a time.
ROW_GROUPS = {"parquet.block.size": str(32 * 1024 * 1024)}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to ``spark`` and return it."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a machine-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage where work must not be repeated (fetches, model calls) and
    survives the loss of executors. The reader also learns the real size, so join
    strategies are picked from facts. The folder is the caller's to clear.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.mode("errorifexists").options(**ROW_GROUPS).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_tasks(spark: SparkSession, rows: int | None = None) -> int:
    """Tasks for work that is slow for its bytes: no more than run at once, as each has a start of
    its own, than shuffles have partitions, or than there are ``rows``."""
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return max(1, n if rows is None else min(n, rows))
