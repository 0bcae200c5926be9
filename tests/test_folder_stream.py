"""The landing folder as a streaming source, and the keyed ledger."""

import json
import os
import re

import pytest
from pyspark.sql.utils import StreamingQueryException

from catalogue_enrich.operators.infer import call_model
from catalogue_enrich.queries import ledger_stream_batches
from catalogue_enrich.sources.folder_stream import FolderReader, stream_folder
from catalogue_enrich.sources.landing import read_landing
from catalogue_enrich.streaming.run import follow, ledger_stream, lines_stream, read_batches
from tests.articles import article
from tests.test_streaming import land, make_fetch, marking_client, places  # noqa: F401


def reader(folder, batch_size=2):
    return FolderReader(
        {"path": f"{folder}/out", "position": f"{folder}/listings", "batch_size": str(batch_size)}
    )


def given(source, start, end):
    parts = source.partitions({"listing": start}, {"listing": end})
    return sorted(os.path.basename(row[0]) for part in parts for row in source.read(part))


def test_offsets(places):  # noqa: F811
    source = reader(places)
    assert source.initialOffset() == source.latestOffset() == {"listing": 0}
    for name in ("a.json", "_b.json", ".c.json"):
        land(places, name, "{}")
    assert [source.latestOffset()["listing"] for _ in range(4)] == [1, 2, 2, 2]
    first, second = given(source, 0, 1), given(source, 1, 2)
    assert sorted(first + second) == [".c.json", "_b.json", "a.json"]
    # The same offsets give the same files, also to another reader.
    assert given(reader(places), 0, 2) == sorted(first + second)
    # A file that was written again is given again, by a reader that goes on from the last listing.
    land(places, "a.json", "[{}, {}]")
    again = reader(places)
    assert again.latestOffset() == {"listing": 3} and given(again, 2, 3) == ["a.json"]


def test_listings_do_not_grow(places):  # noqa: F811
    """What left the folder is forgotten, and old listings are removed."""
    source = reader(places, 10)
    sizes = []
    for batch in range(12):
        for i in range(5):
            land(places, f"{batch}-{i}.json", "{}")
        offset = source.latestOffset()
        sizes.append(os.path.getsize(f"{places}/listings/{offset['listing']}.json"))
        assert len(given(source, offset["listing"] - 1, offset["listing"])) == 5
        source.commit(offset)
        for i in range(5):
            os.rename(f"{places}/out/{batch}-{i}.json", f"{places}/in/{batch}-{i}.json")
    assert max(sizes) < 2 * min(sizes) and len(os.listdir(f"{places}/listings")) <= 4


def test_a_stream_reads_files_and_faults(spark, places):  # noqa: F811
    land(places, "good.json", '{"ä": 1}')
    with open(f"{places}/out/bad.json", "wb") as out:
        out.write("{'ü': 'Müller'}".encode("latin-1"))
    land(places, "other.txt", "{}")
    stream = stream_folder(spark, f"{places}/out", f"{places}/listings", batch_size=1)
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{places}/position")
    query = query.start(f"{places}/read")
    query.processAllAvailable()
    query.stop()
    rows = {r.source_file: r for r in spark.read.parquet(f"{places}/read").collect()}
    assert set(rows) == {"good.json", "bad.json"}
    assert rows["good.json"].document == '{"ä": 1}' and rows["good.json"].read_error is None
    assert rows["bad.json"].document is None and "UTF-8 at byte 2" in rows["bad.json"].read_error
    assert [r.read_error for r in read_landing(spark, f"{places}/out").collect()].count(None) == 1


def run(spark, places, answerer=None, **options):  # noqa: F811
    answerer = answerer or call_model(marking_client(f"{places}/marks"))
    options = {"archive": f"{places}/done", "outbound": f"{places}/in", "batch_size": 2, "validate": False, **options}
    follow(spark, f"{places}/out", f"{places}/tables", make_fetch, answerer, **options).drain()


def test_a_batch_that_died_is_run_again(spark, places):  # noqa: F811
    poison = f"{places}/poison"
    for i in range(3):
        land(places, f"{i}.json", article(i))
    open(poison, "w").close()
    failing = call_model(marking_client(f"{places}/marks", poison))
    with pytest.raises(StreamingQueryException):
        run(spark, places, failing, on_error="fail")
    assert len(os.listdir(f"{places}/out")) == 3
    os.remove(poison)
    land(places, "3.json", article(3))
    run(spark, places, failing, on_error="fail")
    assert os.listdir(f"{places}/out") == []
    assert sorted(os.listdir(f"{places}/done")) == sorted(os.listdir(f"{places}/in"))
    published = read_batches(spark, f"{places}/tables/published")
    assert sorted(r.source_file for r in published.collect()) == [f"{i}.json" for i in range(4)]
    # A call goes on where the last one stopped; what was delivered again is published again.
    land(places, "1.json", article(1, FarbID="new"))
    run(spark, places, failing)
    with open(f"{places}/in/1.json", encoding="utf-8") as done:
        assert json.load(done)["FarbID"] == "new"
    lines = read_batches(spark, f"{places}/tables/failed_images")
    assert lines.count() == lines.select("product_id", "supplier_colour", "url").distinct().count()


def test_inputs_must_leave(spark, places):  # noqa: F811
    with pytest.raises(ValueError):
        run(spark, places, archive=None)


def test_the_ledger_reads_its_own_rows_only(spark, folder):
    """Rows that a batch reads do not grow with the ledger; nulls are equal."""
    for batch in range(6):
        rows = [(f"p{i}", None if i % 2 else "c", "u") for i in range(batch * 3, batch * 3 + 10)]
        lines = spark.createDataFrame(rows, "product_id string, supplier_colour string, url string")
        lines.write.parquet(f"{folder}/lines/batch_id={batch}")
        stream = lines_stream(spark, f"{folder}/lines")
        query = ledger_stream(stream, f"{folder}/ledger", f"{folder}/position")
        query.awaitTermination()
        assert sum(p["numInputRows"] for p in query.recentProgress) == 10
    held = read_batches(spark, f"{folder}/ledger").drop("batch_id")
    assert held.count() == held.distinct().count() == 25


def test_ledger_batches_do_not_grow_with_shuffles_or_files(spark, folder):
    """The state has few parts, whatever shuffles have, and each of 21 batches is one file."""
    for part in range(5):
        rows = [(i if i % 11 else None, i % 7, "error" if i % 3 else None) for i in range(part, 400, 5)]
        events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string")
        events.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    try:
        held = ledger_stream_batches(spark, folder)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "9"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    found = sorted(map(repr, held.collect()))
    assert len(found) == len(set(found)) == 14
    names = [re.search(r"batch_id=([0-9]+)/part-([0-9]+)", f).groups() for f in held.inputFiles()]
    # The batch of null ids is one more.
    assert {int(batch) for batch, _ in names} == set(range(22))
    assert max(int(part) for _, part in names) < spark.sparkContext.defaultParallelism
