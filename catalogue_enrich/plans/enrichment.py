"""The whole chain: article rows to results, raw documents to enriched documents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.images import attach_images, branch, image_slots, with_slots
from ..operators.infer import Answerer, infer, with_results
from ..operators.ledger import failed_lines
from ..operators.normalize import from_documents
from ..operators.prompt import Prompts, with_requests
from ..operators.report import run_metrics
from ..operators.writeback import write_back
from ..schema import ANSWERS, BATCH
from ..session import stage
from ..sources.image_store import ImageStore
from ..sources.images import Fetch, fetch_images, url_registry

Stage = Callable[[DataFrame, str], DataFrame]


def prepare(
    articles: DataFrame,
    images: DataFrame,
    prompts: Prompts = Prompts(),
    with_content: bool = False,
) -> DataFrame:
    """Article rows with ``images``, ``branch`` and the ``requests`` the model will get."""
    return _requested(attach_images(articles, images, with_content), prompts)


def _requested(rows: DataFrame, prompts: Prompts) -> DataFrame:
    rows = rows.withColumn("branch", branch())
    return with_requests(rows, prompts, when=F.col("branch") == "inferred")


def enrich(
    articles: DataFrame,
    images: DataFrame,
    answerer: Answerer,
    prompts: Prompts = Prompts(),
    with_content: bool = False,
) -> DataFrame:
    """Article rows with ``results`` and ``error``.

    One shuffle by URL for the image references and one by article to bring them back; from
    there on an article is one row until it is written, so prompts, calls, parsing and
    write-back are narrow.
    """
    return with_results(infer(prepare(articles, images, prompts, with_content), answerer))


@dataclass(frozen=True)
class Enriched:
    """What a run over raw documents gives."""

    articles: DataFrame  # accepted article rows with results and error
    documents: DataFrame  # source_path, source_file, doc_pos, enriched
    quarantine: DataFrame  # source_path, source_file, doc_pos, document, reason
    ledger: DataFrame  # failed images
    metrics: DataFrame  # metric, value


def enrich_documents(
    raw: DataFrame,
    make_fetch: Callable[[], Fetch],
    answerer: Answerer,
    *,
    prompts: Prompts = Prompts(),
    strict: bool = True,
    on_error: str = "quarantine",
    parallelism: int | None = None,
    stage: Stage = stage,
    kept: ImageStore | None = None,
    **fetch_options,
) -> Enriched:
    """Enrich raw documents (``sources.landing``) with fetched images and a model.

    What must not be done twice is staged: the article rows (read once), the images
    (fetched once per distinct URL) and the answers (asked once). With ``kept`` images are
    fetched once for all calls that share this store.

    A document that is rejected or an answer that is none goes to ``quarantine``; with
    ``on_error='fail'`` the first one fails the job, before anything is staged from it.
    """
    if on_error not in ("quarantine", "fail"):
        raise ValueError(f"on_error: {on_error!r}")

    def checked(rows: DataFrame, column: str) -> DataFrame:
        return rows if on_error == "quarantine" else fail_on(rows, column)

    parsed = stage(checked(from_documents(raw, strict), "reject_reason"), "articles")
    accepted = parsed.where(F.col("reject_reason").isNull()).drop("reject_reason")
    registry = url_registry(accepted)
    fetch_options["parallelism"] = parallelism
    if kept is None:
        images = stage(fetch_images(registry, make_fetch, **fetch_options), "images")
    else:
        images = kept.fetch(registry, make_fetch, stage=stage, **fetch_options)
    answered = asked(accepted, images, answerer, prompts, parallelism, stage)
    enriched = checked(with_results(answered), "error")
    return results_of(parsed, stage(_outcome(enriched), "enriched"))


def asked(
    articles: DataFrame,
    images: DataFrame,
    answerer: Answerer,
    prompts: Prompts,
    parallelism: int | None = None,
    stage: Stage = stage,
) -> DataFrame:
    """Article rows with ``answers``: the model is asked about those that need it alone.

    Which these are is settled without image bytes, once: the flags of their images are staged,
    as they are asked for three times. Only they get the bytes of their images.
    They are dealt to ``parallelism`` tasks by their number, as the calls take long however
    few bytes they are; the others stay where they are.
    """
    n = parallelism or int(articles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = stage(image_slots(articles, images.drop("content")), "image_flags")
    prepared = _requested(with_slots(articles, slots), prompts)
    inferred = F.col("branch") == "inferred"
    waiting = attach_images(prepared.where(inferred).drop("images"), images, with_content=True)
    # Dealt by an expression of the key: a shuffle by the key alone would be taken for that of
    # the join before it, whose partitions are merged by bytes.
    waiting = infer(waiting.repartition(n, F.xxhash64("article_key")), answerer)
    # The bytes have served.
    flags = F.transform("images", lambda i: F.struct(i["pos"], i["url"], i["ok"]))
    waiting = waiting.withColumn("images", flags)
    idle = prepared.where(~inferred).withColumn("answers", F.array().cast(ANSWERS))
    return waiting.unionByName(idle.withColumn("images", flags))


def fail_on(rows: DataFrame, column: str) -> DataFrame:
    """``rows``, failing the job that reads ``column`` where it is not null."""
    found = F.concat_ws(": ", "article_key", column)
    failure = F.when(F.col(column).isNotNull(), F.raise_error(found).cast("string"))
    return rows.withColumn(column, failure)


def _outcome(enriched: DataFrame) -> DataFrame:
    """Enriched article rows without what only the model call needed."""

    def only(items: str, *fields: str) -> Column:
        return F.transform(items, lambda i: F.struct(*(i[f].alias(f) for f in fields)))

    return (
        enriched.drop("requests", "answers")
        .withColumn("images", only("images", "pos", "url", "ok"))
        .withColumn("attributes", only("attributes", "pos", "attribute_id", "result"))
    )


def results_of(parsed: DataFrame, articles: DataFrame) -> Enriched:
    """Outputs of a run from its staged article rows before and after enrichment; of each batch if
    the rows tell theirs."""
    batch = [c for c in (BATCH,) if c in articles.columns]
    origin = ["source_path", "source_file", "doc_pos", *batch]
    done = write_back(articles.where(F.col("error").isNull()))
    rejected = parsed.where(F.col("reject_reason").isNotNull())
    failed = articles.where(F.col("error").isNotNull())

    def set_apart(rows: DataFrame, reason: str) -> DataFrame:
        return rows.select(*origin, "document", F.col(reason).alias("reason"))

    return Enriched(
        articles=articles,
        documents=done.select(*origin, "enriched"),
        quarantine=set_apart(rejected, "reject_reason").union(set_apart(failed, "error")),
        ledger=failed_lines(articles, *batch),
        metrics=run_metrics(articles, *batch),
    )
