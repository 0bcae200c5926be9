"""WARC archives: writing, normalising monolithic gzip, and reading by offset.

An archive that is one gzip stream can only be read from its start. The normaliser inflates each
such stream once, front to back, rewrites every record as a gzip member of its own and writes a
sidecar index of their offsets; any record can then be read alone, so work on archives spreads
over as many tasks as there are parts of the indexes. A stream is handled in chunks and a record
in pieces: memory does not grow with the archive nor with a record.

Tasks write a file under a name of their own and move it in place when it is whole, so a task
that is run again, or twice at once, leaves the same files. Archives that are not whole gzip or
not WARC are reported in the summary (``error``), with the records found before the fault.

Defined results: a null payload is empty; a null id is written as ``null`` and read as null; of
rows with equal id and payload each is written; a null address has no target header.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import open_files, replace_file

LINE = "\r\n"
CHUNK = 1 << 20
INDEX = "archive string, record_id string, kind string, offset long, length long"
SUMMARY = "archive string, records long, bytes long, error string"
RECORD = (
    "record_id string, kind string, refers_to string, payload_bytes long, payload_digest string, "
    "payload binary"
)


def mark_revisits(pages: DataFrame, key: str, payload: str, min_bytes: int = 100) -> DataFrame:
    """``key``, ``url`` if any, payload, digest and, for a record whose payload a smaller ``key``
    has as well, that smallest key as ``refers_to``. Payloads under ``min_bytes`` never refer."""
    body = F.coalesce(F.encode(F.col(payload).cast("string"), "UTF-8"), F.lit(b""))
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(key).alias("key"), url.alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # Keys of payloads that occur more than once; payloads themselves stay out of this shuffle.
    first = (
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("key").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    return rows.join(first, "digest", "left").select(
        "key",
        "url",
        "payload",
        "digest",
        F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )


def _name(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(">"))


def record_bytes(rows: DataFrame) -> Column:
    """A row of ``mark_revisits`` as a WARC record.

    A revisit has the HTTP headers of its payload, which tell the length, and not the payload.
    """
    refers = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(LINE * 2),
    )
    body = F.when(refers, F.lit(b"")).otherwise(F.col("payload"))
    address = F.regexp_replace("url", r"[\x00-\x20]+", "%20")
    head = F.concat(
        F.lit(f"WARC/1.1{LINE}WARC-Type: "),
        F.when(refers, "revisit").otherwise("response"),
        F.lit(f"{LINE}WARC-Record-ID: "),
        _name(F.col("key")),
        F.lit(f"{LINE}WARC-Date: 2000-01-01T00:00:00Z{LINE}WARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.coalesce(F.concat(F.lit(f"{LINE}WARC-Target-URI: "), address), F.lit("")),
        F.when(
            refers,
            F.concat(
                F.lit(f"{LINE}WARC-Refers-To: "),
                _name(F.col("refers_to")),
                F.lit(f"{LINE}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/"),
                F.lit("identical-payload-digest"),
            ),
        ).otherwise(""),
        F.lit(f"{LINE}Content-Type: application/http;msgtype=response{LINE}Content-Length: "),
        (F.octet_length(http) + F.octet_length(body)).cast("string"),
        F.lit(LINE * 2),
    )
    return F.concat(F.encode(F.concat(head, http), "UTF-8"), body, F.lit(LINE.encode()))


def write_monolithic(rows: DataFrame, path: str, records_per_file: int = 50_000) -> None:
    """Write rows of ``mark_revisits`` as archives that are each one gzip stream.

    A record ends in two line ends: one of the record, one as the separator of the writer.
    """
    (
        rows.select(record_bytes(rows).cast("string").alias("value"))
        .write.option("lineSep", LINE)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .option("zlib.compress.level", "BEST_SPEED")
        .text(path)
    )


class BadArchive(Exception):
    """What is read is not a whole gzip stream of WARC records."""


class Inflated:
    """The bytes of a gzip file, of one member or several, inflated chunk by chunk."""

    def __init__(self, stream):
        self.stream, self.held, self.at = stream, b"", 0
        self.inflater, self.ended = zlib.decompressobj(31), False

    def _more(self) -> bool:
        while not self.ended:
            data = self.inflater.unconsumed_tail or self.inflater.unused_data
            if self.inflater.eof:
                self.inflater = zlib.decompressobj(31)
                if not data and not (data := self.stream.read(CHUNK)):
                    self.ended = True
                    return False
            elif not data:
                data = self.stream.read(CHUNK)
            try:
                new = self.inflater.decompress(data, CHUNK)
            except zlib.error as fault:
                raise BadArchive(str(fault)) from fault
            if not data and not new and not self.inflater.eof:
                raise BadArchive("the gzip stream ends too soon")
            if new:
                self.held, self.at = self.held[self.at :] + new, 0
                return True
        return False

    def until(self, mark: bytes, most: int = CHUNK) -> bytes:
        """Bytes up to ``mark``, which is passed over, without the line ends before them; empty at
        the end of the file."""
        while self.at < len(self.held) or self._more():
            if self.held[self.at] not in LINE.encode():
                break
            self.at += 1
        while (end := self.held.find(mark, self.at)) < 0:
            if len(self.held) - self.at > most:
                raise BadArchive("no end of a header")
            if not self._more():
                if self.held[self.at :].strip():
                    raise BadArchive("a header is cut off")
                return b""
        found, self.at = self.held[self.at : end], end + len(mark)
        return found

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes."""
        while n:
            if self.at == len(self.held) and not self._more():
                raise BadArchive("a record is cut off")
            piece = self.held[self.at : self.at + n]
            self.at += len(piece)
            n -= len(piece)
            yield piece


def headers_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").strip().split(LINE)
    if not lines[0].startswith("WARC/"):
        raise BadArchive("a record does not begin with its version")
    pairs = (line.partition(":") for line in lines[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def rewrite(stream, out, level: int) -> Iterator[tuple[str | None, str | None, int, int]]:
    """Copy records from a gzip ``stream`` to ``out``, each as a member; yields id, kind,
    offset and length of every member once it is written."""
    source, offset = Inflated(stream), 0
    while head := source.until((LINE * 2).encode()):
        fields = headers_of(head)
        member, length = zlib.compressobj(level, zlib.DEFLATED, 31), 0

        def put(data: bytes) -> int:
            out.write(data)
            return len(data)

        length += put(member.compress(head + (LINE * 2).encode()))
        for piece in source.pieces(int(fields.get("content-length", 0))):
            length += put(member.compress(piece))
        length += put(member.compress((LINE * 2).encode()) + member.flush())
        yield fields.get("warc-record-id"), fields.get("warc-type"), offset, length
        offset += length


def normalise(spark: SparkSession, source: str, target: str, level: int = 6) -> DataFrame:
    """Rewrite the ``*.gz`` archives of ``source`` into ``target``, with an index beside each.

    Returns one row per archive (``archive, records, bytes, error``); an action on it does the
    work. Index lines are written as the records are, so they are not held either.
    """

    def one(path: str) -> tuple[str, int, int, str | None]:
        files, read = open_files(path)
        target_files, folder = open_files(target)
        target_files.create_dir(folder, recursive=True)
        base = read.rpartition("/")[2].removesuffix(".gz").removesuffix(".txt")
        final = f"{folder}/{base.removesuffix('.warc')}.warc.gz"
        hidden = f"{folder}/.{uuid.uuid4().hex}"
        n = size = 0
        error = None
        with (
            files.open_input_stream(read, compression=None) as stream,
            target_files.open_output_stream(hidden, compression=None) as out,
            target_files.open_output_stream(f"{hidden}.index", compression=None) as index,
        ):
            try:
                for record_id, kind, offset, length in rewrite(stream, out, level):
                    line = {"archive": final.rpartition("/")[2], "record_id": record_id}
                    line |= {"kind": kind, "offset": offset, "length": length}
                    index.write(json.dumps(line).encode() + b"\n")
                    n, size = n + 1, offset + length
            except (BadArchive, ValueError) as fault:
                error = str(fault)
        replace_file(target_files, hidden, final)
        replace_file(target_files, f"{hidden}.index", f"{final}.index")
        return final.rpartition("/")[2], n, size, error

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame(
                [one(path) for path in frame["path"]],
                columns=["archive", "records", "bytes", "error"],
            )

    # The names alone are read here. A row is small and its work is not: the number of tasks is
    # set, as AQE would merge them by size.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source)
    return archives.select("path").repartition(n, "path").mapInPandas(run, SUMMARY)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives of ``folder``, from their indexes."""
    lines = spark.read.schema(INDEX).option("pathGlobFilter", "*.index")
    return lines.json(folder)


def read_records(index: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records that ``index`` names, each read from its offset alone.

    Length and digest are those of the full payload: measured for a response, and for a revisit,
    which has no payload, as its headers tell. A response whose digest is not the one that its
    header tells is a fault.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = open_files(folder)
        name, archive = None, None
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                if r.archive != name:
                    if archive:
                        archive.close()
                    name, archive = r.archive, files.open_input_file(f"{root}/{r.archive}")
                data = zlib.decompress(archive.read_at(r.length, r.offset), 31)
                rows.append(record_of(data, payloads))
            yield pd.DataFrame(
                rows,
                columns=["record_id", "kind", "refers_to"]
                + ["payload_bytes", "payload_digest", "payload"],
            )
        if archive:
            archive.close()

    return index.select("archive", "offset", "length").mapInPandas(run, RECORD)


def record_of(data: bytes, payloads: bool) -> tuple:
    blank = (LINE * 2).encode()
    head, _, rest = data.partition(blank)
    fields = headers_of(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(blank)
    told = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if fields["warc-type"] == "revisit":
        lengths = [
            line.partition(b":")[2] for line in http.split(LINE.encode())
            if line.lower().startswith(b"content-length:")
        ]
        size, digest = int(lengths[0]), told
    else:
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        if told and told != digest:
            raise BadArchive(f"{fields.get('warc-record-id')}: its payload has another digest")
    return (
        fields.get("warc-record-id"),
        fields["warc-type"],
        fields.get("warc-refers-to"),
        size,
        digest,
        payload if payloads else None,
    )


def key_of(name: Column) -> Column:
    """The id in a record's name; null if it was null."""
    return F.nullif(F.regexp_extract(name, r"^<urn:page:(.*)>$", 1), F.lit("null"))
