"""One query per operator over the given tables. Outputs are flat scalars."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema as S
from . import testviews as V
from .functions.encoding import base_name, data_url
from .functions.geometry import thumbnail_size
from .functions.response import parse_response
from .operators.images import ok_images
from .operators.infer import call_model
from .operators.ledger import as_text, failed_lines, new_lines
from .operators.normalize import explode_attributes, explode_images, from_documents
from .operators.prompt import Prompts, messages_json, with_requests
from .operators.report import flat_results, run_metrics, unresolved, without_images
from .operators.writeback import join_results, write_back
from .plans.enrichment import asked, enrich, enrich_documents, prepare
from .session import configure, shared_folder, stage
from .sinks import (
    delete_files,
    last_writes,
    only_processed,
    place_files,
    publish_dataset,
    publish_files,
    stage_files,
    write_files,
)
from .sources.batches import assign_batches, batch_report
from .sources.image_store import ImageStore
from .sources.images import fetch_images, url_registry
from .sources.landing import listed_files, read_landing
from .sources.media import probe
from .streaming.run import (
    append_to_ledger,
    follow,
    ledger_stream,
    lines_stream,
    poll,
    publish_batch,
    read_batches,
    run,
    start,
    write_batch,
)

Query = Callable[[SparkSession, str], DataFrame]


def article_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_documents(V.documents(spark, sf_dir)).select(
        "product_id", "colour_id", "target_group", "reject_reason"
    )


def image_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_images(V.article_rows(spark, sf_dir), "product_id")


def primary_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.article_rows(spark, sf_dir).select("product_id", "product_category")


def attribute_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_attributes(V.article_rows(spark, sf_dir), "product_id")
    return rows.select("product_id", "pos", "attribute_id", "label", "orientation")


def option_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_attributes(V.article_rows(spark, sf_dir), "product_id")
    options = rows.select("product_id", "attribute_id", F.posexplode_outer("options"))
    return options.select(
        "product_id",
        "attribute_id",
        F.col("pos").alias("option_pos"),
        F.col("col.id").alias("option_id"),
        F.col("col.label").alias("option_label"),
    )


def prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_requests(V.article_rows(spark, sf_dir), Prompts())
    return rows.select("product_id", F.explode("requests").alias("r")).select(
        "product_id", "r.attribute_id", "r.system", "r.prompt"
    )


def distinct_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = url_registry(V.article_rows(spark, sf_dir))
    fetched = fetch_images(registry, V.make_fetch, validate=False)
    return fetched.select("url", "n_uses", "ok", F.octet_length("content").alias("n_bytes"))


def _images(rows: DataFrame) -> DataFrame:
    """Images are staged once they are fetched, as their join reads them more than once."""
    return stage(V.images(rows), "images")


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.article_rows(spark, sf_dir)
    return enrich(rows, _images(rows), V.rule_answers)


def image_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.article_rows(spark, sf_dir)
    joined = prepare(rows, _images(rows))
    n_images = F.coalesce(F.size("images"), F.lit(0))
    n_ok = F.size(ok_images())
    return joined.select(
        "product_id",
        F.explode("attributes.pos").alias("pos"),
        n_ok.cast("bigint").alias("n_ok"),
        (n_images - n_ok).cast("bigint").alias("n_failed"),
    )


def data_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = V.table(spark, sf_dir, "pages")
    return pages.select("page_id", data_url(F.encode("html", "UTF-8")).alias("data_url"))


def message_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.article_rows(spark, sf_dir)
    joined = prepare(rows, _images(rows))
    urls = F.transform(ok_images(), lambda i: data_url(F.encode(i["url"], "UTF-8")))
    requests = joined.select("product_id", urls.alias("urls"), F.explode("requests").alias("r"))
    return requests.select(
        "product_id",
        "r.pos",
        messages_json(F.col("r.system"), F.col("r.prompt"), F.col("urls")).alias("messages"),
    )


def response_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    answers = [
        F.concat(F.lit('{"response": "'), kind, F.lit('"}')),
        F.concat(F.lit("not json "), kind),
        F.col("props"),
        F.lit('{"response": null}'),
        F.concat(F.lit('{"response": ["'), kind, F.lit('", "#ff0000"]}')),
        F.concat(F.lit('["'), kind, F.lit('"]')),
        F.lit(None),
        F.concat(F.lit('{"response": "'), kind, F.lit('"} and more')),
    ]
    text = F.element_at(F.array(*answers), (F.col("event_id") % len(answers) + 1).cast("int"))
    parsed = V.table(spark, sf_dir, "events").select("event_id", parse_response(text).alias("p"))
    return parsed.select(
        "event_id",
        "p.kind",
        "p.result_json",
        "p.result",
        F.array_join("p.result_list", ",").alias("result_list"),
    )


def infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flat_results(_enriched(spark, sf_dir))
    return flat.select(
        F.col("article_key").alias("product_id"),
        "pos",
        "attribute_id",
        F.coalesce("result", F.array_join("result_list", ",")).alias("result"),
    )


def _document_results(documents: DataFrame, *keep: str) -> DataFrame:
    """What enriched documents say, read anew."""
    root = F.from_json("enriched", "map<string,string>")
    items = F.from_json(F.col("root")[S.ATTRIBUTES], "array<map<string,string>>")
    return documents.select(*keep, root.alias("root")).select(
        *keep,
        F.col("root")[S.PRODUCT_ID].alias("product_id"),
        F.col("root")["Unbekannt"].alias("unknown"),
        F.posexplode(items).alias("pos", "attribute"),
    ).select(
        *keep,
        "product_id",
        "pos",
        F.col("attribute")[S.IDENTIFIER].alias("attribute_id"),
        F.col("attribute")[S.RESULT].alias("result"),
        F.col("attribute")[S.DESCRIPTION].alias("description"),
        "unknown",
    )


def write_back_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results come as a table of their own and are joined to the raw documents.

    Results and documents have the key that the reader gave: results are shuffled by it without
    their documents.
    """
    articles = stage(from_documents(V.documents(spark, sf_dir)), "articles")
    rows = articles.drop("document")
    results = flat_results(enrich(rows, _images(rows), V.rule_answers)).select(
        "article_key", "pos", "result_json"
    )
    return _document_results(write_back(join_results(articles, results)))


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flat_results(_enriched(spark, sf_dir), "branch")
    return flat.select(F.col("article_key").alias("product_id"), "attribute_id", "branch")


def _failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.article_rows(spark, sf_dir)
    return failed_lines(prepare(rows, _images(rows)))


def failed_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failed(spark, sf_dir)


def ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _failed(spark, sf_dir)
    return new_lines(lines, lines.where(F.col("product_id").cast("bigint") % 2 == 0))


def unresolved_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unresolved(flat_results(_enriched(spark, sf_dir)))


def no_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_images(V.article_rows(spark, sf_dir))


def name_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = V.table(spark, sf_dir, "pages").select("page_id", base_name(F.col("url")).alias("name"))
    done = V.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"))
    return only_processed(pages.where(F.col("name").endswith("=feed")), done, "page_id")


def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = V.table(spark, sf_dir, "documents").select("doc_id")
    return batch_report(assign_batches(files, "doc_id", 100), 100)


def archive_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = V.table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return last_writes(files, ["user_id", "event_type"], "event_id")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_metrics(_enriched(spark, sf_dir))


# Positions of an order that share a row while it is nested: bounds the row.
_CHUNK = 64


def nested_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents, their lines as attributes, the highest price of a
    position as the result written back.

    An order may have any number of lines, so it is nested in chunks of positions; both
    sides are reduced to one row per position before they are shuffled by chunk.
    """
    lines = V.table(spark, sf_dir, "lineitem").select(
        F.struct("l_orderkey", F.expr(f"l_linenumber div {_CHUNK}").alias("chunk")).alias("key"),
        F.col("l_linenumber").alias("pos"),
        "l_extendedprice",
    )
    positions = lines.groupBy("key", "pos")
    documents = (
        positions.agg(F.count("*").alias("n_writes"))
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "n_writes"))).alias("attributes"))
    )
    prices = positions.agg(F.max("l_extendedprice").cast("string").alias("result_json"))
    rebuilt = join_results(documents, prices, "key")
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    # Joined per chunk, not per line: an order with very many lines has few chunks.
    chunks = rebuilt.withColumn("o_orderkey", F.col("key.l_orderkey")).join(orders, "o_orderkey")
    lines_of = F.zip_with(
        "attributes",
        "results",
        lambda a, r: F.struct(
            a["pos"].alias("pos"),
            a["n_writes"].alias("n_writes"),
            r["result_json"].cast("double").alias("value"),
        ),
    )
    return chunks.select("o_orderkey", "o_orderpriority", F.inline(lines_of))


_EVENT = "event_id bigint, user_id bigint, event_type string, value double"
# Events of a landing file, as long as there are no more than so many files.
_PER_FILE, _MOST_FILES = 2500, 240


def _event_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The events as a landing folder of JSON files, read three files at a time.

    A batch costs its start and end however few rows it has, so files, and not their number, grow
    with a large table.
    """
    events = V.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    per_file = max(_PER_FILE, -(-events.count() // _MOST_FILES))
    events.write.option("maxRecordsPerFile", per_file).json(f"{folder}/out")
    return (
        spark.readStream.schema(_EVENT)
        .option("maxFilesPerTrigger", 3)
        .option("pathGlobFilter", "*.json")
        .json(f"{folder}/out")
    )


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "events")
    stream = _event_stream(spark, sf_dir, folder).select("event_id", "event_type", "value")

    def process(batch: DataFrame, batch_id: int) -> None:
        publish_dataset(batch, f"{folder}/in", batch_id)

    start(stream, f"{folder}/_position", process).awaitTermination()
    return read_batches(spark, f"{folder}/in").drop("batch_id")


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "ledger")
    lines = _event_stream(spark, sf_dir, folder).select(
        F.col("user_id").cast("string").alias("product_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("supplier_colour"),
        F.col("event_type").alias("url"),
    )

    def process(batch: DataFrame, batch_id: int) -> None:
        append_to_ledger(batch, f"{folder}/failed_images", batch_id)

    start(lines, f"{folder}/_position", process).awaitTermination()
    return read_batches(spark, f"{folder}/failed_images").drop("batch_id")


def thumbnail_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    width, height = F.col("p_size") * 40, F.floor("p_retailprice").cast("int")
    sizes = V.table(spark, sf_dir, "part").select(
        "p_partkey", thumbnail_size(width, height).alias("out")
    )
    return sizes.select(
        "p_partkey", F.col("out.width").alias("out_w"), F.col("out.height").alias("out_h")
    )


def corrupt_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, props = F.col("event_id"), F.col("props")
    text = (
        F.when(event % 10 == 0, F.substring_index(props, "}", 1))
        .when(event % 10 == 1, F.concat(props, F.lit(" x")))
        .otherwise(props)
    )
    raw = V.table(spark, sf_dir, "events").select(
        event.cast("string").alias("source_path"),
        F.lit("e.json").alias("source_file"),
        text.alias("document"),
    )
    rejected = F.col("reject_reason").isNotNull()
    return from_documents(raw, strict=False).agg(
        F.count_if(~rejected).alias("n_good"), F.count_if(rejected).alias("n_bad")
    )


def enriched_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw documents to enriched documents: the whole text of each."""
    rows = stage(from_documents(V.documents(spark, sf_dir)), "articles")
    return write_back(enrich(rows, _images(rows), V.rule_answers)).select("product_id", "enriched")


def model_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain with images fetched and a client called in Python, as with a real model."""
    rows = V.article_rows(spark, sf_dir)
    images = stage(fetch_images(url_registry(rows), V.make_fetch, validate=False), "images")
    answerer = call_model(V.make_client)
    flat = flat_results(enrich(rows, images, answerer, with_content=True))
    return flat.select(
        F.col("article_key").alias("product_id"),
        "pos",
        "kind",
        F.coalesce("result", F.array_join("result_list", ",")).alias("result"),
        "unresolved",
    )


def folder_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole service: a landing folder of JSON files, drained as a stream of batches.

    Gives what the published files say and whether their inputs were archived.
    """
    folder = shared_folder(spark, "service")
    landing, outbound, archive = f"{folder}/out", f"{folder}/in", f"{folder}/done"
    files = V.documents(spark, sf_dir).withColumn("doc_pos", F.lit(None).cast("int"))
    publish_files(files, landing, "document").write.format("noop").mode("overwrite").save()
    run(
        spark,
        landing,
        f"{folder}/tables",
        V.make_fetch,
        call_model(V.make_client),
        batch_size=1000,
        outbound=outbound,
        archive=archive,
        validate=False,
    ).awaitTermination()
    published = read_landing(spark, outbound).withColumnRenamed("document", "enriched")
    archived = read_landing(spark, archive).select("source_file", F.lit(True).alias("archived"))
    return _document_results(published.join(archived, "source_file", "left"), "archived")


def array_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = from_documents(V.array_documents(spark, sf_dir))
    return rows.select(
        "source_file",
        F.col("doc_pos").cast("bigint").alias("doc_pos"),
        "product_id",
        F.size("attributes").cast("bigint").alias("n_attributes"),
        "reject_reason",
    )


def large_array_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All articles as a few files of very many each, read back article by article."""
    folder = shared_folder(spark, "arrays")

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sign = "["
        for frame in frames:
            if len(frame):
                after = [sign + frame["document"].iloc[0], *("," + d for d in frame["document"].iloc[1:])]
                yield pd.DataFrame({"value": after})
                sign = ","
        yield pd.DataFrame({"value": ["[]" if sign == "[" else "]"]})

    V.documents(spark, sf_dir).select("document").mapInPandas(lines, "value string").write.text(folder)
    rows = from_documents(read_landing(spark, folder, glob="*.txt", articles=True))
    return rows.where("reject_reason is distinct from 'no_articles'").select(
        "product_id",
        "colour_id",
        F.size("attributes").cast("bigint").alias("n_attributes"),
        F.col("doc_pos").isNotNull().alias("in_array"),
        "reject_reason",
    )


def folder_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder as the only state: files of any name, some broken, until none is left.

    Gives per file how many articles were published, whether it was archived, and why not.
    """
    folder = shared_folder(spark, "state")
    landing, archive = f"{folder}/out", f"{folder}/done"
    files = V.array_documents(spark, sf_dir)
    kind = F.col("n") % 4
    hidden = F.when(kind == 1, "_").when(kind == 2, ".").otherwise("")
    files = files.select(
        F.concat(hidden, "source_file").alias("source_file"),
        F.when(kind == 3, F.concat("document", F.lit("]"))).otherwise(F.col("document")).alias("document"),
        F.lit(None).cast("int").alias("doc_pos"),
    )
    write_files(files, landing).write.format("noop").mode("overwrite").save()
    done = poll(
        spark,
        landing,
        f"{folder}/tables",
        V.make_fetch,
        call_model(V.make_client),
        batch_size=25,
        archive=archive,
        validate=False,
    )
    if done.left:
        raise RuntimeError(f"{done.left} files are left")
    published = read_batches(spark, f"{folder}/tables/published").groupBy("source_file")
    published = published.agg(F.count("*").alias("n_articles"))
    reasons = read_batches(spark, f"{folder}/tables/quarantine").select("source_file", "reason")
    return (
        read_landing(spark, archive)
        .select("source_file")
        .join(published, "source_file", "left")
        .join(reasons.distinct(), "source_file", "left")
        .select("source_file", F.coalesce("n_articles", F.lit(0)).alias("n_articles"), "reason")
    )


def folder_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder as a streaming source: hidden names, files that are not UTF-8, files delivered
    again after the service stopped, and a start from where it was.

    Gives per archived file how often it was read, its published articles, and why not.
    """
    folder = shared_folder(spark, "follow")
    landing, archive = f"{folder}/out", f"{folder}/done"
    kind = F.col("n") % 4
    hidden = F.when(kind == 1, "_").when(kind == 2, ".").otherwise("")
    files = V.array_documents(spark, sf_dir).withColumn("source_file", F.concat(hidden, "source_file"))
    broken = F.when(kind == 0, F.concat("document", F.lit("]"))).otherwise(F.col("document"))

    def deliver(rows: DataFrame, form: Callable[[str], str | bytes] = str) -> None:
        write_files(rows, landing, form).write.format("noop").mode("overwrite").save()
        followed = follow(
            spark,
            landing,
            f"{folder}/tables",
            V.make_fetch,
            call_model(V.make_client),
            batch_size=15,
            archive=archive,
            validate=False,
        )
        followed.drain()

    deliver(files.where(kind == 3), lambda text: text.encode("latin-1"))
    deliver(files.where(kind != 3).withColumn("document", broken))
    deliver(files.where(kind == 0))
    tables = f"{folder}/tables"
    reads = read_batches(spark, f"{tables}/files").where("state = 'processed'")
    name = F.url_decode(F.element_at(F.split("source_path", "/"), -1)).alias("source_file")
    reads = reads.groupBy(name).agg(F.count("*").alias("n_reads"))
    published = read_batches(spark, f"{tables}/published").groupBy("source_file")
    published = published.agg(F.count("*").alias("n_articles"))
    reasons = read_batches(spark, f"{tables}/quarantine").select("source_file", "reason").distinct()
    return (
        read_landing(spark, archive)
        .select("source_file")
        .join(reads, "source_file", "left")
        .join(published, "source_file", "left")
        .join(reasons, "source_file", "left")
        .select("source_file", "n_reads", F.coalesce("n_articles", F.lit(0)).alias("n_articles"), "reason")
    )


def ledger_stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of 20 batches, one of which is written again after the stream has stopped."""
    folder = shared_folder(spark, "keyed")
    lines = V.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("product_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("supplier_colour"),
        F.col("event_type").alias("url"),
        (F.col("event_id") % 20).alias("batch_id"),
    )
    written = f"{folder}/failed_lines"
    # A batch is a file.
    lines.repartitionByRange(20, "batch_id").write.partitionBy("batch_id").parquet(written)

    def catch_up() -> None:
        stream = lines_stream(spark, written, files_per_batch=1)
        ledger_stream(stream, f"{folder}/ledger", f"{folder}/_position").awaitTermination()

    catch_up()
    publish_dataset(lines.where("batch_id = 7").drop("batch_id").repartition(1), written, 7)
    catch_up()
    return read_batches(spark, f"{folder}/ledger").drop("batch_id")


def _land(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Files of several articles in ``folder``; the names end in several ways."""
    kind = F.col("n") % 3
    end = F.when(kind == 0, ".json").when(kind == 1, ".txt").otherwise("")
    files = V.array_documents(spark, sf_dir).withColumn("source_file", F.concat("n", end))
    write_files(files, folder).write.format("noop").mode("overwrite").save()
    return files


def any_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of any name are read if no pattern is asked for."""
    folder = shared_folder(spark, "names")
    _land(spark, sf_dir, folder)
    rows = from_documents(read_landing(spark, folder, glob=None))
    return rows.groupBy("source_file").agg(F.count("*").alias("n_articles"))


def delete_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs deleted by name: what was asked for, whether it went, and what is still there."""
    folder = shared_folder(spark, "inputs")
    files = _land(spark, sf_dir, folder)
    here, absent = F.col("source_file"), F.concat("source_file", F.lit(".absent"))
    asked = files.where("n % 2 = 0").select(F.explode(F.array(here, absent)).alias("name"))
    paths = asked.select(F.concat(F.lit(f"{folder}/"), "name").alias("source_path"))
    report = stage(delete_files(paths), "deleted")
    name = F.element_at(F.split("path", "/"), -1).alias("source_file")
    left = listed_files(spark, folder, None).select(
        F.element_at(F.split("source_path", "/"), -1).alias("source_file"), F.lit(True).alias("is_there")
    )
    told = report.select(name, F.col("done").alias("deleted"))
    both = told.join(left, "source_file", "full")
    return both.select("source_file", "deleted", F.coalesce("is_there", F.lit(False)).alias("is_there"))


def hard_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which a call failed are set apart with the failure; others are published."""
    raw = V.documents(spark, sf_dir)
    answerer = call_model(V.make_limited_client, sleep=lambda seconds: None)
    done = enrich_documents(raw, V.make_fetch, answerer, validate=False)
    published = done.documents.select("source_file", F.lit(None).cast("string").alias("reason"))
    return published.union(done.quarantine.select("source_file", "reason"))


def url_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transport errors are tried three times, other errors once."""
    registry = url_registry(V.article_rows(spark, sf_dir))
    fetched = fetch_images(registry, V.make_flaky_fetch, attempts=3, pause=0, validate=False)
    return fetched.select("url", "ok", "error")


def kept_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches that share images: even articles, all, and all again, which fetches none but
    those that failed."""
    rows = V.article_rows(spark, sf_dir)
    store = ImageStore(shared_folder(spark, "image-store"), slots=64)
    even = rows.where(F.col("product_id").cast("long") % 2 == 0)
    for batch, articles in enumerate((even, rows, rows)):
        images = store.fetch(url_registry(articles), V.make_batch_fetch(batch), validate=False)
    fetched_in = F.substring_index(F.decode("content", "UTF-8"), ":", 1).cast("int")
    return images.select("url", "n_uses", "ok", fetched_in.alias("fetched_in"))


def idle_exit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The service ends once it has looked in vain; a later call finds nothing to do."""
    folder = shared_folder(spark, "idle")
    files = V.array_documents(spark, sf_dir)
    write_files(files, f"{folder}/out").write.format("noop").mode("overwrite").save()

    def look() -> tuple[int, int, int]:
        done = poll(
            spark,
            f"{folder}/out",
            f"{folder}/tables",
            V.make_fetch,
            call_model(V.make_client),
            batch_size=25,
            idle_checks=2,
            poll_seconds=0,
            delete_inputs=True,
            validate=False,
        )
        return done.batches, done.files, done.left

    calls = [(i, *look()) for i in range(2)]
    return spark.createDataFrame(calls, "call int, batches int, files int, left int")


def replayed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that stopped after its manifest and some of its names is published again: every
    name has the new document, old ones are replaced."""
    folder = shared_folder(spark, "replay")
    outbound, target = f"{folder}/in", f"{folder}/tables"
    documents = V.documents(spark, sf_dir).withColumn("doc_pos", F.lit(None).cast("int"))
    documents = documents.withColumnRenamed("document", "enriched")
    old = documents.where("hash(source_file) % 3 = 0").withColumn("document", F.lit('{"old": true}'))
    publish_files(old, outbound, "document").write.format("noop").mode("overwrite").save()
    manifest = write_batch(stage_files(documents, outbound, 0), f"{target}/staged_files", 0)
    some = manifest.where("hash(path) % 2 = 0")
    place_files(some, outbound, 0).write.format("noop").mode("overwrite").save()
    publish_batch(documents, outbound, target, 0)
    root = F.from_json("document", "map<string,string>")
    published = read_landing(spark, outbound, glob=None)
    return published.select("source_file", root[S.PRODUCT_ID].alias("product_id"))


def image_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = url_registry(V.article_rows(spark, sf_dir))
    fetched = fetch_images(registry, V.make_image_fetch)
    probed = fetched.select("url", "ok", probe(F.col("content")).alias("p"))
    return probed.select(
        "url",
        "ok",
        "p.media_type",
        "p.width",
        "p.height",
        "p.needs_rgb",
        F.col("p.out.width").alias("out_w"),
        F.col("p.out.height").alias("out_h"),
    )


def model_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each request was asked, and with which error in the end."""
    rows = V.article_rows(spark, sf_dir)
    images = _images(rows).withColumn("content", F.encode("url", "UTF-8"))
    answerer = call_model(V.make_limited_client, sleep=lambda seconds: None)
    answers = asked(rows, images, answerer, Prompts()).select(
        F.col("article_key").alias("product_id"), F.inline("answers")
    )
    return answers.select("product_id", "pos", "tries", "error")


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_documents(V.faulty_documents(spark, sf_dir)).select("source_file", "reject_reason")


def ledger_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(_failed(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "q01_article_scan": article_scan,
    "q02_image_list": image_list,
    "q03_primary_category": primary_category,
    "q04_attribute_explode": attribute_explode,
    "q05_option_map": option_map,
    "q06_prompt_render": prompt_render,
    "q07_distinct_fetch": distinct_fetch,
    "q08_image_join": image_join,
    "q09_data_url": data_urls,
    "q10_message_assembly": message_assembly,
    "q11_response_parse": response_parse,
    "q12_infer": infer,
    "q13_write_back": write_back_join,
    "q14_branch": branches,
    "q15_failed_ledger": failed_ledger,
    "q16_ledger_append": ledger_append,
    "q17_unresolved": unresolved_report,
    "q18_no_images": no_images,
    "q19_name_filter": name_filter,
    "q20_batch_assign": batch_assign,
    "q21_archive_last_wins": archive_last_wins,
    "q22_run_metrics": metrics,
    "q23_nested_rebuild": nested_rebuild,
    "q24_stream_batches": stream_batches,
    "q25_stream_dedupe": stream_dedupe,
    "q26_thumbnail_geometry": thumbnail_geometry,
    "q27_corrupt_quarantine": corrupt_quarantine,
    "q28_enriched_documents": enriched_documents,
    "q29_model_calls": model_calls,
    "q30_folder_run": folder_run,
    "q31_array_documents": array_documents,
    "q32_folder_state": folder_state,
    "q33_image_validation": image_validation,
    "q34_model_retries": model_retries,
    "q35_reject_reasons": reject_reasons,
    "q36_ledger_text": ledger_text,
    "q37_folder_stream": folder_stream,
    "q38_ledger_stream": ledger_stream_batches,
    "q39_any_extension": any_extension,
    "q40_delete_inputs": delete_inputs,
    "q41_hard_failure": hard_failure,
    "q42_url_retries": url_retries,
    "q43_idle_exit": idle_exit,
    "q44_replayed_batch": replayed_batch,
    "q45_kept_images": kept_images,
    "q46_large_array_files": large_array_files,
}


def configured(query: Query) -> Query:
    """``query`` on a session that has the settings the operators rely on."""

    def on(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return on
