"""From raw documents to packed sequences: the stages of the training-data pipeline."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import catalogue_enrich
from catalogue_enrich.llm.common import ARROW_ROWS, staged, table
from catalogue_enrich.llm.linedup import dedup_lines
from catalogue_enrich.llm.mixing import mix, word_count
from catalogue_enrich.llm.neardup import without_near_duplicates
from catalogue_enrich.llm.packing import numbered, pack
from catalogue_enrich.llm.quality import divergence_quality
from catalogue_enrich.llm.queries import MIX_LEVELS, MIX_SEED, MIX_WEIGHTS, domain, make_encoder

# Python workers get the package with the functions they run.
cloudpickle.register_pickle_by_value(catalogue_enrich)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Rows of a batch of texts.
BATCH = 1000
# Words and their ids that a Python worker keeps. It lives on through later stages, beside the
# JVM and other workers.
KEPT_WORDS = 100_000


def small_batches(spark: SparkSession) -> None:
    """From now on texts are handed to Python in small batches: each is held by the worker, with its
    result, and by the JVM, with the rows that it is made from. For the session, as what a stage
    returns is run by its caller; written here it would take its size of disk again."""
    spark.conf.set(ARROW_ROWS, BATCH)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and look like their language."""
    small_batches(spark)
    judged, verdict = divergence_quality(docs)
    return judged.where(f"{verdict}.kept").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones have; those left without a word go."""
    small_batches(spark)
    deduped, result = dedup_lines(docs)
    text = F.when(F.col(f"{result}.n_deleted") > 0, F.col(f"{result}.text")).otherwise(docs["text"])
    columns = [text.alias(c) if c == "text" else docs[c] for c in docs.columns]
    length = F.char_length("text").cast("long")
    left = deduped.where(
        (F.col(f"{result}.n_deleted") == 0) | F.col(f"{result}.text").rlike(r"[^ \t-\r]")
    ).select(*columns)
    return left.withColumn("n_chars", length) if "n_chars" in docs.columns else left


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return without_near_duplicates(docs, width=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target mix; a document may be drawn in two epochs."""
    # The level is no column of the result.
    rows = docs.withColumn("domain", domain())
    mixed, _ = mix(
        rows, MIX_LEVELS, word_count("text"), "doc_id", MIX_WEIGHTS, max_epochs=2, seed=MIX_SEED
    )
    return mixed.select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens or a smaller power of two, numbered within each length."""
    encoder = partial(make_encoder, KEPT_WORDS)
    sequences = pack(docs.select("doc_id", "lang", "source", "text"), encoder)
    columns = ["doc_id", "lang", "source", "piece.*", "bucket", "task", "nth"]
    return numbered(sequences.select(columns))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("packing", packing),
]
# Alignment, similarity links and tokens have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, name)
    return docs
