"""Published documents and input files (K1-K4)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from urllib.parse import unquote, urlsplit

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .schema import BATCH
from .session import ROW_GROUPS

DONE = "path string, done boolean, error string"


def publish_dataset(documents: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch as a partition of a table; writing it again replaces it."""
    documents.write.mode("overwrite").options(**ROW_GROUPS).parquet(f"{path}/batch_id={batch_id}")


def publish_datasets(rows: DataFrame, path: str, batches: Sequence[int]) -> None:
    """Write several batches as partitions of a table, by the column ``batch_id``; writing them again
    replaces them.

    They are written aside by one job and then get their names; a batch without rows is an empty
    partition. Marks of completion are set in order when all are there, so all are there if the last
    one has its mark.
    """
    if len(batches) == 1:
        publish_dataset(rows.drop(BATCH), path, batches[0])
        return
    spark = rows.sparkSession
    aside = f"{path}/_batches-{batches[0]}"  # Spark passes over such names
    writer = rows.write.mode("overwrite").options(**ROW_GROUPS).partitionBy(BATCH)
    writer.parquet(aside)
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    folder = new_path(aside)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    written = {entry.getPath().getName() for entry in fs.listStatus(folder)}
    places = {n: new_path(f"{path}/{BATCH}={n}") for n in batches}
    for n, place in places.items():
        fs.delete(place, True)
        if f"{BATCH}={n}" not in written:
            fs.mkdirs(place)
        elif not fs.rename(new_path(f"{aside}/{BATCH}={n}"), place):
            raise OSError(f"cannot name {path}/{BATCH}={n}")
    for n in places:
        fs.create(new_path(f"{path}/{BATCH}={n}/_SUCCESS")).close()
    fs.delete(folder, True)


def published_name() -> Column:
    """File name an article is published under: its own, or ``<file>.d/<n>.json`` for the
    n-th article of a file that holds an array (no landing file has such a name)."""
    return F.when(F.col("doc_pos").isNull(), F.col("source_file")).otherwise(
        F.concat("source_file", F.lit(".d/"), F.col("doc_pos"), F.lit(".json"))
    )


def publish_files(documents: DataFrame, folder: str, document: str = "enriched") -> DataFrame:
    """Write each article as a JSON file of the same name, replacing what is there.

    UTF-8, unescaped, two-space indent, key order kept. Returns ``path, done, error`` per file, and
    its ``batch_id`` if it has one; consume it once to write.
    """
    files = documents.select(
        published_name().alias("source_file"), F.col(document).alias("document"), *_batch_of(documents)
    )
    return write_files(files, folder, _indented)


def stage_files(
    documents: DataFrame, folder: str, batch_id: int, document: str = "enriched"
) -> DataFrame:
    """The files of ``publish_files``, written into a hidden folder of the batch in ``folder``.

    The report, once it is committed as a table, is the batch's manifest: nothing has its name
    yet, and all is there for ``place_files`` to give it.
    """
    return publish_files(documents, staging(folder, batch_id), document)


def staging(folder: str, batch_id: int) -> str:
    return f"{folder}/.batch-{batch_id}"


def place_files(
    manifest: DataFrame, folder: str, batch_id: int, tasks: int | None = None
) -> DataFrame:
    """Give the staged files of ``manifest`` their names in ``folder``, replacing what is there.

    May be stopped and run again: a staged file goes only by getting its name, so one that is gone
    has been placed (and may have been taken since). Returns ``path, done, error`` per file;
    consume it once.
    """

    def place(path: str, listed: tuple | None) -> str:
        files, root = open_files(folder)
        _, hidden = open_files(staging(folder, batch_id))
        target = f"{root}{path.removeprefix(hidden)}"
        if is_file(files, path):
            files.create_dir(target.rpartition("/")[0], recursive=True)
            replace_file(files, path, target)
        return target

    paths = manifest.select(F.col("path").alias("source_path"), *_batch_of(manifest))
    return _on_files(paths, place, tasks)


def clear_staging(folder: str, batch_id: int) -> None:
    """Remove the hidden folder of a batch whose files have their names."""
    files, path = open_files(staging(folder, batch_id))
    if files.get_file_info(path).type == arrow_fs.FileType.Directory:
        files.delete_dir(path)


def _indented(text: str) -> str:
    return json.dumps(json.loads(text), indent=2, ensure_ascii=False)


def write_files(
    files: DataFrame, folder: str, form: Callable[[str], str | bytes] = str
) -> DataFrame:
    """Write ``document`` of each row to a file named ``source_file``, replacing what is there.

    Tasks write their own files and put each in place whole, so a re-run task does no harm.
    Returns ``path, done, error`` per file, and its ``batch_id`` if it has one; consume it once to write.
    """

    def write(name: str, text: str) -> str:
        file_system, root = open_files(folder)
        target = f"{root}/{name}"
        file_system.create_dir(target.rpartition("/")[0], recursive=True)
        hidden = f"{target.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        with file_system.open_output_stream(hidden, compression=None) as out:
            content = form(text)
            out.write(content if isinstance(content, bytes) else content.encode("utf-8"))
        replace_file(file_system, hidden, target)
        return target

    batch = _batch_of(files)
    rows = files.select(F.col("source_file").alias("name"), F.col("document").alias("text"), *batch)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            names, texts = frame["name"], frame["text"]
            yield _each(names, lambda i: write(names.iloc[i], texts.iloc[i]), frame[batch])

    return rows.mapInPandas(run, _report(batch))


def _batch_of(files: DataFrame) -> list[str]:
    return [BATCH] if BATCH in files.columns else []


def _report(batch: list[str]) -> str:
    return ", ".join([DONE, *(f"{c} int" for c in batch)])


def archive_files(files: DataFrame, folder: str, tasks: int | None = None) -> DataFrame:
    """Move the files named by ``source_path`` into ``folder``; the last write wins.

    With columns ``modified`` and ``length`` a file that is no longer as it was listed stays: it
    was written anew and has not been read. A file that is already there and no longer here
    counts as moved, so a replay is harmless. A file that cannot be moved is reported, not
    raised. Consume the result once.
    """

    def move(path: str, listed: tuple | None) -> str:
        source_fs, source = open_files(path)
        _, root = open_files(folder)
        target = f"{root}/{source.rpartition('/')[2]}"
        source_fs.create_dir(root, recursive=True)
        _unchanged(source_fs, source, listed)
        if is_file(source_fs, source) or not is_file(source_fs, target):
            replace_file(source_fs, source, target)
        return target

    return _on_files(files, move, tasks)


def delete_files(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Delete the files named by ``source_path``; same rules and report as ``archive_files``."""

    def delete(path: str, listed: tuple | None) -> str:
        source_fs, source = open_files(path)
        _unchanged(source_fs, source, listed)
        source_fs.delete_file(source)
        return source

    return _on_files(files, delete, tasks)


def _unchanged(files: arrow_fs.FileSystem, path: str, listed: tuple | None) -> None:
    if listed is not None and is_file(files, path):
        info = files.get_file_info(path)
        if (info.mtime_ns // 1_000_000, info.size) != listed:
            raise OSError("written again since it was read")


def only_processed(files: DataFrame, processed: DataFrame, name: str) -> DataFrame:
    """The ``files`` whose ``name`` is among the ``processed`` ones.

    Repeated names of ``processed`` are dropped before the shuffle.
    """
    return files.join(processed.select(name).distinct(), name, "left_semi")


def last_writes(files: DataFrame, destination: list[str], order_by: str) -> DataFrame:
    """Of the files that share a ``destination``, the one written last by ``order_by``.

    A maximum, not a ranking: it is combined before the shuffle, so a destination with very
    many writes costs one row per task.
    """
    others = [c for c in files.columns if c not in destination]
    newest = F.max_by(F.struct(*others), order_by).alias("newest")
    return files.groupBy(*destination).agg(newest).select(*destination, "newest.*")


def open_files(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and plain path of a URI or local path."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        path = unquote(parts.path) if parts.scheme else uri
        return arrow_fs.LocalFileSystem(), path.rstrip("/")
    scheme = "s3" if parts.scheme == "s3a" else parts.scheme
    files, path = arrow_fs.FileSystem.from_uri(f"{scheme}{uri[len(parts.scheme):]}")
    return files, path.rstrip("/")


def is_file(files: arrow_fs.FileSystem, path: str) -> bool:
    return files.get_file_info(path).type == arrow_fs.FileType.File


_REPLACED = ".replaced"


def replace_file(files: arrow_fs.FileSystem, source: str, target: str) -> None:
    """Move ``source`` to ``target``, whatever is there.

    Where a store does not move over a file, the old one is put aside under a hidden name until
    the new one has its place, and ``restore_replaced`` brings it back if that never happened.
    """
    try:
        files.move(source, target)
    except OSError:
        if not (is_file(files, source) and is_file(files, target)):
            raise
        folder, _, name = target.rpartition("/")
        aside = f"{folder}/.{name}{_REPLACED}"
        if is_file(files, aside):
            files.delete_file(aside)
        files.move(target, aside)
        files.move(source, target)
        files.delete_file(aside)


def restore_replaced(files: arrow_fs.FileSystem, folder: str) -> None:
    """Finish what ``replace_file`` was stopped at in ``folder``: every name has its old or its new
    file."""
    if files.get_file_info(folder).type != arrow_fs.FileType.Directory:
        return
    for entry in files.get_file_info(arrow_fs.FileSelector(folder)):
        name = entry.base_name
        if entry.is_file and name.startswith(".") and name.endswith(_REPLACED):
            target = f"{folder}/{name[1:].removesuffix(_REPLACED)}"
            if is_file(files, target):
                files.delete_file(entry.path)
            else:
                files.move(entry.path, target)


def _each(paths: Iterable[str], act: Callable[[int], str], batch: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for i, path in enumerate(paths):
        try:
            rows.append((act(i), True, None))
        except Exception as failure:
            rows.append((path, False, f"{type(failure).__name__}: {failure}"))
    done = pd.DataFrame(rows, columns=["path", "done", "error"])
    return done.assign(**{c: batch[c].to_numpy() for c in batch})


def _on_files(
    files: DataFrame, act: Callable[[str, tuple | None], str], tasks: int | None = None
) -> DataFrame:
    listed = ["modified", "length"] if {"modified", "length"} <= set(files.columns) else []
    batch = _batch_of(files)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            states = list(zip(*(frame[c].tolist() for c in listed), strict=True)) if listed else None
            paths = frame["source_path"]
            yield _each(paths, lambda i: act(paths.iloc[i], states[i] if listed else None), frame[batch])

    # A file operation is slow and its row is small: the number of tasks is set, as AQE
    # would merge them by size.
    n = tasks or int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paths = files.select("source_path", *listed, *batch).repartition(n, "source_path").distinct()
    return paths.mapInPandas(run, _report(batch))
