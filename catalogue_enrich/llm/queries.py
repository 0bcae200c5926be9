"""One query per operator over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from . import chat, warc
from .ann import nearest
from .common import table
from .grammar import read_shards, write_tokens
from .lexical import search
from .linedup import dedup_lines
from .metric_trees import compress
from .mixing import mix, word_count
from .neardup import forest_components
from .oracle import CHAT_SQL, SEARCH_SQL, TREES_SQL, WARC_SQL, mix_sql
from .packing import numbered, pack, word_ids
from .quality import divergence_quality
from .secrets import NOVEL, scan_secrets
from .sharding import place

Query = Callable[[SparkSession, str], DataFrame]


TOKENIZER = "word_bpe_49k.json"


def op1_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    monolithic, members = shared_folder(spark, "warc"), shared_folder(spark, "members")
    warc.write_monolithic(warc.mark_revisits(pages, "page_id", "html"), monolithic)
    faults = warc.normalise(spark, monolithic, members).where("error is not null").collect()
    if faults:
        raise ValueError(f"archives that cannot be read: {faults}")
    records = warc.read_records(warc.read_index(spark, members), members)
    return records.select(
        warc.key_of(F.col("record_id")).cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("kind").alias("record_type"),
        warc.key_of(F.col("refers_to")).cast("long").alias("refers_to"),
    )


def op2_divergence_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged, verdict = divergence_quality(documents)
    return judged.select("doc_id", f"{verdict}.*")


def _spans(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")


def op3_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(embeddings, F.col("id") % 100 == 0)


def op4_novel_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned, secrets = scan_secrets(documents)
    # One level of columns, so that the operator's result is worked out once.
    rows = scanned.select("doc_id", f"{secrets}.*")
    base = F.filter("found", lambda s: s.kind != NOVEL)
    return rows.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "n_novel",
        F.sha2(_spans(base), 256).alias("base_sha256"),
        _spans(F.col("found")).alias("spans"),
        F.array_max(F.transform("found", lambda s: s.novelty)).alias("most_novel"),
    )


def op5_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return forest_components(documents, width=3, percent=85)


# The target mix: weights among siblings; others weigh 1. A domain is a quarter of the sources.
MIX_LEVELS = ["domain", "lang", "source"]
MIX_WEIGHTS = {
    ("d0",): 4,
    ("d1",): 3,
    ("d2",): 2,
    ("d0", "en"): 3,
    ("d1", "en"): 3,
    ("d2", "en"): 2,
    ("d0", "en", "src0"): 3,
}
MIX_SHARE, MIX_SEED = 0.8, 11


def domain() -> Column:
    number = F.regexp_extract(F.col("source").cast("string"), r"([0-9]+)$", 1)
    return F.concat(F.lit("d"), F.nullif(number, F.lit("")).cast("long") % 4)


def op6_hierarchical_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", domain().alias("domain"), "lang", "source", word_count("text").alias("words")
    )
    mixed, name = mix(
        documents,
        MIX_LEVELS,
        F.col("words"),
        "doc_id",
        MIX_WEIGHTS,
        budget_share=MIX_SHARE,
        max_epochs=2,
        seed=MIX_SEED,
    )
    return mixed.select("doc_id", *MIX_LEVELS, f"{name}.*")


def op7_line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    deduped, result = dedup_lines(documents)
    return deduped.select("doc_id", f"{result}.*")


def make_encoder(most: int | None = None) -> Callable[[list[bytes]], list[bytes]]:
    """The public word tokenizer, found where the task runs; ``most`` words are kept there."""
    import public_tokenizers

    return word_ids(public_tokenizers.path(TOKENIZER), most)


def op8_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    sequences = pack(documents, make_encoder)
    columns = ["piece.start", "piece.length", "piece.ids_crc32", "piece.doc_tokens"]
    pieces = numbered(sequences.select("doc_id", *columns, "bucket", "task", "nth"))
    return pieces.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket", "place"
    )


def op9_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(data).cast("long") + 8).alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    return place(documents, "doc_id", 24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_event_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    injected = spark.range(2).select(F.lit(-7).cast("long"), F.col("id"), role, said)
    log, message, sequence = chat.events_of(turns.union(injected))
    messages = chat.reconstruct(log, "conversation", message, sequence)
    read = chat.read_back(chat.render(messages))
    return read.withColumnRenamed("conversation", "conv_id")


def op11_limited_accumulators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


# Where tokens are written, workers hold little else.
WRITER_WORDS = 1_500_000


def op12_repair_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return read_shards(write_tokens(documents, partial(make_encoder, WRITER_WORDS)))


def op13_anchor_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, _ = compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)
    return codes.drop("label")


QUERIES: dict[str, Query] = {
    "op1_warc_normaliser": op1_warc_normaliser,
    "op2_divergence_quality": op2_divergence_quality,
    "op3_cross_polytope": op3_cross_polytope,
    "op4_novel_secrets": op4_novel_secrets,
    "op5_lsh_forest": op5_lsh_forest,
    "op6_hierarchical_budget": op6_hierarchical_budget,
    "op7_line_alignment": op7_line_alignment,
    "op8_power_of_two_packing": op8_power_of_two_packing,
    "op9_bounded_ring": op9_bounded_ring,
    "op10_event_chat": op10_event_chat,
    "op11_limited_accumulators": op11_limited_accumulators,
    "op12_repair_grammar": op12_repair_grammar,
    "op13_anchor_trees": op13_anchor_trees,
}

ORACLE: dict[str, str] = {
    "op1_warc_normaliser": WARC_SQL,
    "op6_hierarchical_budget": mix_sql(MIX_LEVELS, MIX_WEIGHTS, MIX_SHARE, MIX_SEED),
    "op10_event_chat": CHAT_SQL,
    "op11_limited_accumulators": SEARCH_SQL,
    "op13_anchor_trees": TREES_SQL,
}
