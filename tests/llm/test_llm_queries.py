"""The registered queries against SQL, and the pipeline stage by stage."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from catalogue_enrich.llm import linedup
from catalogue_enrich.llm.queries import ORACLE, QUERIES
from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(spark, name, QUERIES[name], ORACLE[name], SF) == []


ODD = [
    (1, None, "en", "src1", None),
    (2, "", None, None, 0),
    (3, "word " * 40_000, "en", "src0", 5),
    (None, "a null key with some text in it", "xx", "other", 1),
]


@pytest.fixture(scope="module")
def stages(spark):
    """The input of every stage and the result of the last."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([*ODD, *ODD], docs.schema)
    docs = docs.union(docs.limit(20)).union(odd).withColumn("quality", F.lit("clash"))
    frames = [corpus_pipeline.staged(docs, "input")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(corpus_pipeline.staged(stage(spark, frames[-1], SF), name))
    return frames


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "source_mix", "packing",
    ]
    assert all(f.columns == stages[0].columns for f in stages[1:-1])


def test_quality_only_removes(stages):
    before, after = stages[0], stages[1]
    assert after.exceptAll(before).count() == 0
    assert after.where("size(split(trim(text), '[ \\t-\\r]+')) < 20").count() == 0


def test_no_long_line_is_left_twice(stages):
    lines = stages[2].select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.where(F.size(F.split(F.trim("line"), r"[ \t-\r]+")) >= 30)
    held = lines.groupBy(F.trim("line")).agg(F.countDistinct("doc_id").alias("n"))
    assert held.where("n > 1").count() == 0


def test_one_document_of_a_group_stays(stages):
    before, after = stages[2], stages[3]
    assert after.exceptAll(before).count() == 0
    assert after.count() == after.select("doc_id", "text").distinct().count()


def test_packed_sequences_hold_every_document(stages):
    packed = stages[5].groupBy("doc_id").agg(F.sum("length").alias("n"))
    asked = stages[4].groupBy("doc_id").count()
    assert packed.join(asked, "doc_id").count() == asked.where("doc_id is not null").count()
    assert stages[5].where("length > 2048 or offset <> 0").count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() == rows.select("sequence_id").distinct().count() > 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), "empty")
        assert docs.count() == 0


def test_texts_are_judged_and_cut_in_small_batches(spark, monkeypatch):
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    seen, staged = [], linedup.staged
    before = spark.conf.get(rows)
    monkeypatch.setattr(linedup, "staged", lambda df, purpose: seen.append(spark.conf.get(rows)) or staged(df, purpose))
    monkeypatch.setattr(corpus_pipeline, "BATCH", 7)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    try:
        for stage in (corpus_pipeline.quality_rules, corpus_pipeline.line_dedup):
            spark.conf.set(rows, "10000")
            result = stage(spark, docs, SF)
            # What is run later, by the caller.
            assert spark.conf.get(rows) == "7"
            assert result.count() <= 20
        spark.conf.set(rows, "10000")
        linedup.dedup_lines(docs)
        assert seen == ["1000", "1000"]
    finally:
        spark.conf.set(rows, before)


def test_a_worker_of_the_pipeline_keeps_few_words(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "KEPT_WORDS", 10)
    monkeypatch.setattr(corpus_pipeline, "numbered", lambda sequences: sequences)
    made = []
    monkeypatch.setattr(corpus_pipeline, "pack", lambda docs, make: made.append(make) or docs.select(
        *[F.lit(0).alias(c) for c in ("doc_id", "lang", "source", "bucket", "task", "nth")],
        F.struct(F.lit(0).alias("start")).alias("piece"),
    ))
    docs = spark.createDataFrame([(1, "en", "src0", "x")], "doc_id long, lang string, source string, text string")
    corpus_pipeline.packing(spark, docs, SF)
    encode = made[0]()
    assert encode([b" ".join(b"word%d" % i for i in range(100))])[0]
    assert len(encode.known) + len(encode.known.before) <= 10
