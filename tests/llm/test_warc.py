"""Archives: an exact round trip, and streams that are not whole."""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from catalogue_enrich.llm import warc

LONG = "x" * 150
PAGES = [
    (1, "http://a/1", LONG),
    (2, "http://a/2 b\r\nEvil: 1", LONG),
    (3, None, None),
    (4, "http://a/4", ""),
    (5, "http://a/5", "short\r\n\r\nWARC/1.1\r\n"),
    (6, "http://a/6", "short\r\n\r\nWARC/1.1\r\n"),
    (7, "http://a/7", "ü€😀" * 900_000),
    (None, "http://a/8", LONG),
    (9, "http://a/9", "only once, but long enough to be referred to " * 9),
    (9, "http://a/9", "only once, but long enough to be referred to " * 9),
]


def rows(spark, pages, folder, per_file=50_000):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    df = df.withColumn("digest", F.lit("a column of the input")).coalesce(1)
    warc.write_monolithic(warc.mark_revisits(df, "page_id", "html"), f"{folder}/mono", per_file)
    summary = warc.normalise(spark, f"{folder}/mono", f"{folder}/members").collect()
    index = warc.read_index(spark, f"{folder}/members")
    return summary, index, warc.read_records(index, f"{folder}/members", payloads=True).collect()


def test_round_trip(spark, folder):
    summary, index, records = rows(spark, PAGES, folder)
    assert [s.error for s in summary] == [None] * len(summary)
    assert sum(s.records for s in summary) == len(PAGES) == len(records)
    got = sorted(
        (r.record_id, r.kind, r.refers_to, r.payload_bytes, r.payload_digest) for r in records
    )
    want = []
    for page_id, _, html in PAGES:
        body = (html or "").encode()
        first = min((p for p, _, h in PAGES if p and (h or "").encode() == body), default=None)
        refers = len(body) >= 100 and first is not None and page_id != first
        name = "<urn:page:null>" if page_id is None else f"<urn:page:{page_id}>"
        want.append(
            (name, "revisit" if refers else "response")
            + (f"<urn:page:{first}>" if refers else None,)
            + (len(body), hashlib.sha256(body).hexdigest())
        )
    assert got == sorted(want, key=lambda w: (w[0], w[1], w[2] or "", w[3], w[4]))
    for r in records:
        if r.kind == "response":
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest
        else:
            assert r.payload == b""


def test_every_record_is_a_member_of_its_own(spark, folder):
    summary, index, _ = rows(spark, PAGES, folder, per_file=4)
    assert len(summary) >= 3
    for archive in {r.archive for r in index.collect()}:
        entries = sorted(index.where(F.col("archive") == archive).collect(), key=lambda r: r.offset)
        data = open(f"{folder}/members/{archive}", "rb").read()
        at = 0
        for e in entries:
            assert e.offset == at
            assert zlib.decompress(data[at : at + e.length], 31).startswith(b"WARC/1.1\r\n")
            at += e.length
        assert at == len(data)


def test_running_again_leaves_the_same_files(spark, folder):
    rows(spark, PAGES, folder)
    names = [r.archive for r in warc.read_index(spark, f"{folder}/members").distinct().collect()]
    before = {n: open(f"{folder}/members/{n}", "rb").read() for n in names}
    warc.normalise(spark, f"{folder}/mono", f"{folder}/members").collect()
    assert before == {n: open(f"{folder}/members/{n}", "rb").read() for n in names}


def test_empty_table(spark, folder):
    _, _, records = rows(spark, PAGES[:0], folder)
    assert records == []


def record(n: int, body: bytes) -> bytes:
    head = f"WARC/1.1\r\nWARC-Record-ID: <urn:page:{n}>\r\nWARC-Type: response\r\n"
    return head.encode() + f"Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("size", [0, 1, 1000, 3_000_000])
@pytest.mark.parametrize("members", [False, True])
def test_streams_of_one_or_many_members(size, members):
    records = [record(i, bytes([65 + i]) * size) for i in range(4)]
    data = b"".join(map(gzip.compress, records)) if members else gzip.compress(b"".join(records))
    out = io.BytesIO()
    entries = list(warc.rewrite(io.BytesIO(data), out, 6))
    assert [e[0] for e in entries] == [f"<urn:page:{i}>" for i in range(4)]
    for i, (_, _, offset, length) in enumerate(entries):
        assert zlib.decompress(out.getvalue()[offset : offset + length], 31) == records[i]


@pytest.mark.parametrize(
    "data",
    [
        gzip.compress(record(1, b"a" * 500))[:-20],
        gzip.compress(record(1, b"a" * 500)[:-100]),
        gzip.compress(record(1, b"ab") + b"no version\r\n\r\n"),
        b"not gzip at all",
    ],
)
def test_faults_are_told(spark, folder, data):
    with pytest.raises(warc.BadArchive):
        list(warc.rewrite(io.BytesIO(data), io.BytesIO(), 6))
    open(f"{folder}/bad.warc.gz", "wb").write(data)
    (summary,) = warc.normalise(spark, folder, f"{folder}/members").collect()
    assert summary.error and summary.archive == "bad.warc.gz"
