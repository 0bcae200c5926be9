"""Enrichment as a stream of bounded micro-batches.

A batch costs its planning however few its files are. So batches that wait are run together, as one
round: each has its number, its files and its partition of the tables, and each step is one job for all
of them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import islice

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from ..operators.infer import Answerer
from ..operators.ledger import new_lines
from ..operators.report import RUN_METRICS, file_counts
from ..plans.enrichment import enrich_documents
from ..schema import BATCH, LEDGER_KEY
from ..session import configure, few_tasks
from ..sinks import (
    DONE,
    archive_files,
    clear_staging,
    delete_files,
    open_files,
    place_files,
    publish_dataset,
    publish_datasets,
    replace_file,
    restore_replaced,
    stage_files,
)
from ..sources.folder_stream import stream_folder
from ..sources.images import Fetch
from ..sources.landing import FILE, File, hadoop, list_files, read_files, stream_landing

# Batches of a round, and their files, at most; a batch may have more files and is then a round alone.
TOGETHER = 128
FILES_TOGETHER = 20_000


def write_batch(df: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Write a batch's partition of a table and read it back; a replay replaces it."""
    publish_dataset(df, path, batch_id)
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/batch_id={batch_id}")


def write_batches(df: DataFrame, path: str, batches: Sequence[int]) -> DataFrame:
    """``write_batch`` for the batches of a round: rows tell theirs in ``batch_id``."""
    publish_datasets(df, path, batches)
    return _partitions(df, path, batches)


def _partitions(like: DataFrame, path: str, batches: Sequence[int]) -> DataFrame:
    """Some batches of a table whose columns are those of ``like``, and ``batch_id``."""
    reader = like.sparkSession.read.schema(_with_batch(like)).option("basePath", path)
    return reader.parquet(*(f"{path}/{BATCH}={n}" for n in batches))


def _with_batch(rows: DataFrame) -> StructType:
    return StructType([*(f for f in rows.schema if f.name != BATCH), StructField(BATCH, IntegerType())])


def read_batches(
    spark: SparkSession, path: str, before: int | None = None, schema: str | None = None
) -> DataFrame | None:
    """All batches of a table, or those before ``before``; None if there are none. With ``schema``,
    that of the table without its batches, no file is opened to learn it."""
    try:
        reader = spark.read.schema(f"{schema}, batch_id int") if schema else spark.read
        table = reader.parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return table if before is None else table.where(F.col("batch_id") < before)


def append_to_ledger(lines: DataFrame, path: str, batch_id: int) -> None:
    """Append the lines that no earlier batch has; a replayed batch gives the same lines."""
    held = read_batches(lines.sparkSession, path, batch_id, ", ".join(f"{c} string" for c in LEDGER_KEY))
    fresh = lines.dropDuplicates(LEDGER_KEY) if held is None else new_lines(lines, held)
    publish_dataset(fresh, path, batch_id)


def append_round(lines: DataFrame, path: str, batches: Sequence[int]) -> None:
    """``append_to_ledger`` for the batches of a round: a line goes to the first that has it."""
    if len(batches) == 1:
        append_to_ledger(lines.drop(BATCH), path, batches[0])
        return
    key = F.struct(*LEDGER_KEY).alias("key")
    first = lines.groupBy(key).agg(F.min(BATCH).alias(BATCH))
    held = read_batches(lines.sparkSession, path, batches[0], ", ".join(f"{c} string" for c in LEDGER_KEY))
    if held is not None:
        # Structs compare null-safe.
        first = first.join(new_lines(lines, held).select(key), "key", "left_semi")
    publish_datasets(first.select("key.*", BATCH), path, batches)


def publish_batch(
    documents: DataFrame,
    outbound: str,
    target: str,
    batch_id: int | Sequence[int],
    tasks: int | None = None,
) -> DataFrame:
    """Publish the files of a batch, all or none: ``path, done, error`` of each. Those of a round's
    batches, which tell theirs in ``batch_id``, are published together.

    Files are written aside; their manifest (``staged_files`` below ``target``) is committed by
    Spark, and only then do they get their names. A batch that runs again goes on from what was
    committed: it writes all files anew, or gives those of the manifest their names, or has
    nothing to do.
    """
    spark = documents.sparkSession
    batches = [batch_id] if isinstance(batch_id, int) else batch_id
    first = batches[0]

    def step(name: str, report: Callable[[], DataFrame]) -> DataFrame:
        path = f"{target}/{name}"
        if _is_complete(spark, path, batches[-1]):
            done = _partitions(spark.createDataFrame([], DONE), path, batches)
            if not done.where(~F.col("done")).head(1):
                return done
        done = write_batches(report(), path, batches)
        if faults := done.where(~F.col("done")).head(1):
            raise OSError(f"batch {first} is not fully published: {faults[0]}")
        return done

    manifest = step("staged_files", lambda: stage_files(documents, outbound, first))
    placed = step("published_files", lambda: place_files(manifest, outbound, first, tasks))
    clear_staging(outbound, first)
    return placed


def _is_complete(spark: SparkSession, path: str, batch_id: int) -> bool:
    fs, marker = hadoop(spark, f"{path}/batch_id={batch_id}/_SUCCESS")
    return fs.exists(marker)


def _next_batch(spark: SparkSession, target: str) -> int:
    """One more than the last batch that came to its end; found without listing them all."""
    path, step = f"{target}/metrics", 1
    while _is_complete(spark, path, step - 1):
        step *= 2
    low, high = step // 2, step  # batch low - 1 is complete, batch high - 1 is not
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if _is_complete(spark, path, middle - 1) else (low, middle)
    return low


def _size_of_round(batch_size: int, together: int) -> int:
    """Files that are given out together: whole batches."""
    return batch_size * max(1, min(together, FILES_TOGETHER // batch_size))


def _numbered(files: Sequence[tuple], first: int, batch_size: int) -> tuple[list[tuple], range]:
    """Files with the batch of each, and the batches, from ``first`` on."""
    batches = range(first, first + max(1, -(-len(files) // batch_size)))
    return [(*file, first + i // batch_size) for i, file in enumerate(files)], batches


def _round_of(target: str, number: int) -> range | None:
    """The batches of the micro-batch ``number``, if they are settled."""
    files, path = open_files(f"{target}/_rounds/{number}.json")
    try:
        with files.open_input_stream(path, compression=None) as source:
            return range(*json.loads(source.read()))
    except FileNotFoundError:
        return None


def _first_of(target: str, number: int) -> int:
    """The first batch of the micro-batch ``number``: batches are counted on, whatever is run together.
    Without a round before it, it is the number itself."""
    if (own := _round_of(target, number)) is not None:
        return own.start
    before = _round_of(target, number - 1) if number else None
    return number if before is None else before.stop


def _settle(
    files: DataFrame, target: str, number: int, batch_size: int
) -> tuple[DataFrame, range]:
    """The files of the micro-batch ``number`` with the batch of each, and the batches. Both are kept,
    so a micro-batch that runs again has the same ones."""
    spark, path = files.sparkSession, f"{target}/inputs"
    batches = _round_of(target, number)
    if batches is None:
        first = _first_of(target, number)
        # About ``FILES_TOGETHER`` files at most, as a larger batch is alone.
        listed = files.collect() if batch_size <= FILES_TOGETHER else []
        rows, batches = _numbered(sorted(map(tuple, listed)), first, batch_size)
        if len(batches) > 1:
            publish_datasets(spark.createDataFrame(rows, _with_batch(files)), path, batches)
        _keep_round(target, number, batches)
    if len(batches) == 1:
        return files.withColumn(BATCH, F.lit(batches[0])), batches
    return _partitions(files, path, batches), batches


def _keep_round(target: str, number: int, batches: range) -> None:
    files, folder = open_files(f"{target}/_rounds")
    files.create_dir(folder, recursive=True)
    hidden = f"{folder}/.{uuid.uuid4().hex}"
    with files.open_output_stream(hidden, compression=None) as out:
        out.write(json.dumps([batches.start, batches.stop]).encode())
    replace_file(files, hidden, f"{folder}/{number}.json")


def run(
    spark: SparkSession,
    landing: str,
    target: str,
    make_fetch: Callable[[], Fetch],
    answerer: Answerer,
    *,
    batch_size: int = 100,
    together: int = TOGETHER,
    poll_seconds: int | None = None,
    outbound: str | None = None,
    archive: str | None = None,
    delete_inputs: bool = False,
    **options,
) -> StreamingQuery:
    """Start enriching the JSON files that arrive in ``landing``.

    Without ``poll_seconds`` the query drains the folder and stops; with it, it stays and
    looks again after that many seconds. Each batch of at most ``batch_size`` files leaves a
    ``batch_id`` partition in the tables ``articles, images, image_flags, enriched, published,
    quarantine, failed_images, metrics`` below ``target``, and, if asked, a file per article
    in ``outbound`` and its inputs moved to ``archive`` (or deleted). The stream's position
    is kept below ``target`` too, so batch ids and tables belong together. ``archive`` may
    lie in ``landing`` but is better beside it: Spark lists sub-folders, though it reads no
    file of them.

    Up to ``together`` batches that wait are run as one round, of at most ``FILES_TOGETHER`` files
    unless a batch has more. Their images are fetched once for all: ``images`` and ``image_flags`` lie
    with the first batch of the round.

    A round that died is run again and replaces its partitions; stages it had completed
    are read, not repeated, so finished model calls are not made twice. Inputs are moved
    only after all outputs are written; the metrics count the moves and come last.
    """
    configure(spark)
    process = _batch_process(
        target, make_fetch, answerer, batch_size, outbound, archive, delete_inputs, options
    )

    size, tasks = _size_of_round(batch_size, together), few_tasks(spark)

    def batch(raw: DataFrame, number: int) -> None:
        if size <= FILES_TOGETHER:
            # Spark takes a small file for one of 4 MB: a round would be hundreds of tasks.
            raw = raw.coalesce(tasks)
        listed, batches = _settle(raw.select("source_path"), target, number, batch_size)
        process(raw, listed, batches)

    stream = stream_landing(spark, landing, size)
    # The files of a round are listed anew by name, by as many tasks as there are files if it may.
    with _settings(spark, {LISTING_TASKS: 4 * tasks}):
        return start(stream, f"{target}/_position", batch, poll_seconds)


@dataclass(frozen=True)
class Drained:
    """What ``poll`` did: batches, files processed in them, and files that are still there."""

    batches: int
    files: int
    left: int


def poll(
    spark: SparkSession,
    landing: str,
    target: str,
    make_fetch: Callable[[], Fetch],
    answerer: Answerer,
    *,
    batch_size: int = 100,
    together: int = TOGETHER,
    poll_seconds: float = 60,
    idle_checks: int = 1,
    outbound: str | None = None,
    archive: str | None = None,
    delete_inputs: bool = False,
    **options,
) -> Drained:
    """Enrich the JSON files of ``landing`` until ``idle_checks`` looks found nothing to do.

    The folder is the state: what lies there is still to do, of any age and name, and a file
    that is delivered again is processed again and replaces what was published and archived of
    it. So inputs must leave the folder: name ``archive`` or ``delete_inputs``. A file that was
    processed and cannot be moved is not processed again while it stays as it is; the move is
    tried again at every look. A file that cannot be read is set apart (``unreadable`` in
    ``quarantine``) and tried again by the next call. Neither keeps others from their turn.

    A look reads the listing page by page and takes batches of ``batch_size`` from it, which are run
    in rounds as those of ``run``. Tables below ``target`` are those of ``run``, and ``files``, the
    inputs of each batch with their state. Not to be mixed with ``run`` on one ``target``.
    """
    if not (archive or delete_inputs):
        raise ValueError("poll needs archive or delete_inputs")
    configure(spark)
    process = _batch_process(
        target, make_fetch, answerer, batch_size, outbound, archive, delete_inputs, options
    )
    first = batch_id = _next_batch(spark, target)
    size = _size_of_round(batch_size, together)
    n_files, tasks = 0, few_tasks(spark, size)

    def done(files: list[File], before: int) -> tuple[list[File], list[File]]:
        """Of the files listed those still to do, and those that only have to be moved."""
        listed = spark.createDataFrame(files, FILE)
        states = read_batches(spark, f"{target}/files", before, f"{FILE}, state string")
        if states is None:
            return files, []
        known = listed.join(states, ["source_path", "modified", "length"])
        # What could not be read is tried again by another call.
        known = known.where((F.col("state") == "processed") | (F.col("batch_id") >= first))
        state = {r["source_path"]: r["state"] for r in known.collect()}
        moves = [f for f in files if state.get(f.source_path) == "processed"]
        return [f for f in files if f.source_path not in state], moves

    def process_round(inputs: DataFrame, batches: range) -> None:
        nonlocal batch_id, n_files
        n_files += process(read_files(inputs, tasks), inputs, batches)
        batch_id = batches.stop

    def process_files(files: list[File]) -> None:
        rows, batches = _numbered(files, batch_id, batch_size)
        inputs = spark.createDataFrame(rows, f"{FILE}, {BATCH} int")
        process_round(write_batches(inputs, f"{target}/inputs", batches), batches)

    listed_before = batch_id
    while _is_complete(spark, f"{target}/inputs", listed_before):
        listed_before += 1
    if listed_before > batch_id:
        # The last run died after it had listed its files: go on with those.
        batches = range(batch_id, listed_before)
        inputs = _partitions(spark.createDataFrame([], FILE), f"{target}/inputs", batches)
        process_round(inputs, batches)
    idle = left = 0
    while idle < idle_checks:
        if idle:
            time.sleep(poll_seconds)
        found, left, waiting = False, 0, []
        listing = list_files(spark, landing)
        while files := list(islice(listing, size)):
            new, moves = done(files, batch_id)
            if moves:
                paths = spark.createDataFrame(moves, FILE)
                moved = archive_files(paths, archive, tasks) if archive else delete_files(paths, tasks)
                left += moved.where(~F.col("done")).count()
            left += len(files) - len(new) - len(moves)
            waiting += new
            while len(waiting) >= size:
                some, waiting, found = waiting[:size], waiting[size:], True
                process_files(some)
        if waiting:
            process_files(waiting)
            found = True
        idle = 0 if found else idle + 1
    return Drained(batch_id - first, n_files, left)


@dataclass(frozen=True)
class Following:
    """The queries of ``follow``: of batches, and of the ledger behind them."""

    batches: StreamingQuery
    ledger: StreamingQuery

    def drain(self) -> None:
        """Process what is there, then stop; raises what a batch failed with."""
        try:
            self.batches.processAllAvailable()
            self.ledger.processAllAvailable()
        finally:
            self.stop()

    def stop(self) -> None:
        self.batches.stop()
        self.ledger.stop()


def follow(
    spark: SparkSession,
    landing: str,
    target: str,
    make_fetch: Callable[[], Fetch],
    answerer: Answerer,
    *,
    batch_size: int = 100,
    together: int = TOGETHER,
    poll_seconds: float = 0,
    outbound: str | None = None,
    archive: str | None = None,
    delete_inputs: bool = False,
    **options,
) -> Following:
    """Enrich the JSON files of ``landing`` as a stream whose source is the folder itself.

    Files of any name and age are read, files that are delivered again are processed again, and a
    batch costs the same however many came before: the source (``sources.folder_stream``) carries
    on only what still lies in the folder, and the ledger is kept by key (``ledger_stream``). Name
    ``archive`` or ``delete_inputs``, so that inputs leave the folder; what cannot be read or
    moved is not given out again while it stays as it is. ``drain`` of the result processes what
    is there and stops; a later call goes on from there.

    Batches that wait are run in rounds as those of ``run``. Tables below ``target`` are those of
    ``poll``, and ``raw``, with the first batch of a round its files as they were read, so a round that
    runs again does not depend on the folder. ``failed_lines`` holds the
    failed images of each batch and ``failed_images`` what the ledger had not held before.
    """
    if not (archive or delete_inputs):
        raise ValueError("follow needs archive or delete_inputs")
    configure(spark)
    process = _batch_process(
        target,
        make_fetch,
        answerer,
        batch_size,
        outbound,
        archive,
        delete_inputs,
        options,
        note=lambda lines, batches: publish_datasets(lines, f"{target}/failed_lines", batches),
    )

    def batch(files: DataFrame, number: int) -> None:
        path, first = f"{target}/raw", _first_of(target, number)
        if _is_complete(files.sparkSession, path, first):
            rows = files.sparkSession.read.schema(files.schema).parquet(f"{path}/batch_id={first}")
        else:
            rows = write_batch(files, path, first)
        listed = rows.select("source_path", "modified", "length")
        listed, batches = _settle(listed, target, number, batch_size)
        process(rows.drop("modified", "length"), listed, batches)

    size = _size_of_round(batch_size, together)
    files = stream_folder(spark, landing, f"{target}/_listings", size)
    writer = files.writeStream.option("checkpointLocation", f"{target}/_position").foreachBatch(batch)
    batches = writer.trigger(processingTime=f"{poll_seconds} seconds").start()
    lines = lines_stream(spark, f"{target}/failed_lines")
    position = f"{target}/_ledger_position"
    ledger = ledger_stream(lines, f"{target}/failed_images", position, poll_seconds)
    return Following(batches, ledger)


def lines_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Ledger rows as batches write them below ``path``; those of a batch that was written again
    come again."""
    fs, folder = hadoop(spark, path)
    fs.mkdirs(folder)
    schema = ", ".join(f"{c} string" for c in LEDGER_KEY)
    reader = spark.readStream.schema(f"{schema}, batch_id int").option("ignoreMissingFiles", "true")
    lines = reader.option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return lines.select(*LEDGER_KEY)


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ledger_stream(
    lines: DataFrame, path: str, position: str, poll_seconds: float | None = None
) -> StreamingQuery:
    """Append the rows of the stream ``lines`` that no earlier batch had to the table ``path``.

    What the ledger holds is keyed state: a batch looks up its own rows and reads nothing else,
    however long the ledger is. Every batch stores each part of the state anew, however few its
    rows, so the state has few parts; their number is that of the first start. Nulls are equal. A
    batch that runs again replaces its partition. Without ``poll_seconds`` the stream is drained
    and stops.
    """
    spark = lines.sparkSession
    with _settings(
        spark, {STATE_STORE: _ROCKS_DB, "spark.sql.shuffle.partitions": few_tasks(spark)}
    ):
        fresh = lines.select(*LEDGER_KEY).dropDuplicates(LEDGER_KEY)
        return start(fresh, position, lambda rows, n: publish_dataset(rows, path, n), poll_seconds)


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, object]) -> Iterator[None]:
    """The session with ``settings``, for a query that is started inside: it keeps those it began with."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def at_once(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """What ``steps`` give, which do not depend on each other; raises, after all have ended, what the
    first of those that failed failed with. A small batch is planned for longer than it is run, by
    one thread of the driver, so steps of it are planned side by side."""
    with ThreadPoolExecutor(len(steps)) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in begun]


def _batch_process(
    target: str,
    make_fetch: Callable[[], Fetch],
    answerer: Answerer,
    batch_size: int,
    outbound: str | None,
    archive: str | None,
    delete_inputs: bool,
    options: dict,
    note: Callable[[DataFrame, Sequence[int]], None] | None = None,
) -> Callable[[DataFrame, DataFrame, Sequence[int]], int]:
    """What is done with the raw documents of a round; gives the number of files processed.

    ``listed`` tells the batch of each file and, unless Spark's file stream gave them, which does not
    know it, how they were listed. ``note`` takes the failed images of each batch; if there is none
    they are appended to the ledger.
    """

    for folder in (outbound, archive):
        if folder:
            restore_replaced(*open_files(folder))

    def process(raw: DataFrame, listed: DataFrame, batches: Sequence[int]) -> int:
        session, first = raw.sparkSession, batches[0]

        def staged(df: DataFrame, name: str) -> DataFrame:
            path = f"{target}/{name}"
            if name == "articles":
                df = with_batch(df)
            if BATCH not in df.columns:
                # Of the whole round: images, which its batches share.
                if _is_complete(session, path, first):
                    return session.read.schema(df.schema).parquet(f"{path}/batch_id={first}")
                return write_batch(df, path, first)
            if _is_complete(session, path, batches[-1]):
                return _partitions(df, path, batches)
            if len(batches) > 1:
                # Rows of a batch lie together, so a batch is few files here and in what is made of it.
                df = df.repartition(few_tasks(session, len(batches)), BATCH)
            return write_batches(df, path, batches)

        def with_batch(articles: DataFrame) -> DataFrame:
            if len(batches) == 1:
                return articles.withColumn(BATCH, F.lit(first))
            own = listed.select("source_path", BATCH)
            return articles.join(own, "source_path").select(*articles.columns, BATCH)

        tasks = few_tasks(session, batch_size * len(batches))
        reports: dict[str, DataFrame] = {}
        settings = {"parallelism": few_tasks(session), **options}
        done = enrich_documents(raw, make_fetch, answerer, stage=staged, **settings)
        unread = F.col("reject_reason").eqNullSafe("unreadable")
        origin = session.createDataFrame([], "source_path string, reject_reason string")
        seen = _partitions(origin, f"{target}/articles", batches)
        is_listed = "modified" in listed.columns
        inputs = seen.where(~unread).select("source_path", BATCH).distinct()
        if is_listed:
            inputs = listed.join(inputs.select("source_path"), "source_path", "left_semi")

        def publish() -> None:
            documents = write_batches(done.documents, f"{target}/published", batches)
            if outbound:
                reports["published"] = publish_batch(documents, outbound, target, batches, tasks)

        def set_apart() -> None:
            publish_datasets(done.quarantine, f"{target}/quarantine", batches)

        def note_failed() -> None:
            if note:
                note(done.ledger, batches)
            else:
                append_round(done.ledger, f"{target}/failed_images", batches)

        def note_states() -> None:
            if is_listed:
                state = F.when(F.col("read").isNull(), "unreadable").otherwise("processed")
                read = inputs.select("source_path", F.lit(True).alias("read"))
                marked = listed.join(read, "source_path", "left").withColumn("state", state)
                publish_datasets(marked.drop("read"), f"{target}/files", batches)

        def count_files() -> dict[int, int]:
            return {r[BATCH]: r["count"] for r in inputs.groupBy(BATCH).count().collect()}

        def count_skipped() -> dict[int, int]:
            counted = F.countDistinct(F.when(unread, F.col("source_path"))).alias("skipped")
            return {r[BATCH]: r["skipped"] for r in seen.groupBy(BATCH).agg(counted).collect()}

        # As many rows as batches, or metrics of batches.
        *_, files, skipped, counted = at_once(
            session, publish, set_apart, note_failed, note_states, count_files, count_skipped,
            done.metrics.collect,
        )
        if archive:
            moved = archive_files(inputs, archive, tasks)
            reports["archived"] = write_batches(moved, f"{target}/archived_files", batches)
        elif delete_inputs:
            deleted = delete_files(inputs, tasks)
            reports["deleted"] = write_batches(deleted, f"{target}/deleted_files", batches)
        if reports:
            counted += file_counts(BATCH, **reports).collect()
        names = [*RUN_METRICS, *(f"{name}_{what}" for name in reports for what in ("asked", "done"))]
        metrics = {(n, name): 0 for n in batches for name in names}
        metrics |= {(r[BATCH], r["metric"]): r["value"] for r in counted}
        for n in batches:
            metrics[n, "files"] = files.get(n, 0)
            metrics[n, "more_available"] = int(files.get(n, 0) == batch_size)
            metrics[n, "files_skipped"] = skipped.get(n, 0)
        rows = [(name, value, n) for (n, name), value in metrics.items()]
        table = session.createDataFrame(rows, f"metric string, value bigint, {BATCH} int")
        publish_datasets(table.coalesce(1), f"{target}/metrics", batches)
        return sum(files.values())

    return process


def start(
    stream: DataFrame,
    position: str,
    process: Callable[[DataFrame, int], object],
    poll_seconds: int | None = None,
) -> StreamingQuery:
    """Run ``process`` per micro-batch: until drained, or polling every ``poll_seconds``."""
    def batch(rows: DataFrame, batch_id: int) -> None:
        process(rows, batch_id)

    writer = stream.writeStream.option("checkpointLocation", position).foreachBatch(batch)
    if poll_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{poll_seconds} seconds").start()
