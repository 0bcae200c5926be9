import json
import os
import uuid

import pytest

from catalogue_enrich.operators.infer import call_model
from catalogue_enrich.operators.normalize import from_documents
from catalogue_enrich.sinks import archive_files
from catalogue_enrich.sources.landing import FILE, File, list_files, read_files
from catalogue_enrich.streaming.run import (
    Drained,
    _next_batch,
    append_to_ledger,
    poll,
    read_batches,
    run,
)
from tests.articles import MISSING, RESULT, article


def make_fetch():
    def fetch(url):
        if "/2/" in url:
            raise OSError("no")
        return url.encode()

    return fetch


def marking_client(marks, poison=None):
    """Answers, and leaves a file per call; raises on every call while ``poison`` exists."""

    def make():
        def client(messages, wants_list, **_):
            if poison and os.path.exists(poison):
                raise RuntimeError("poisoned")
            open(f"{marks}/{uuid.uuid4().hex}", "w").close()
            return '{"response": ["#ff0000"]}' if wants_list else '{"response": "kiste"}'

        return client

    return make


def land(folder, name, document):
    with open(f"{folder}/out/{name}", "w", encoding="utf-8") as out:
        out.write(document if isinstance(document, str) else json.dumps(document, ensure_ascii=False))


@pytest.fixture()
def places(folder):
    for name in ("out", "in", "marks"):
        os.mkdir(f"{folder}/{name}")
    return folder


def stream(spark, places, answerer=None, **options):
    answerer = answerer or call_model(marking_client(f"{places}/marks"))
    options = {"outbound": f"{places}/in", "archive": f"{places}/out/done", "batch_size": 2, "validate": False, **options}
    return run(spark, f"{places}/out", f"{places}/tables", make_fetch, answerer, **options)


def published(places):
    return {n: json.load(open(f"{places}/in/{n}", encoding="utf-8")) for n in os.listdir(f"{places}/in")}


def test_folder_is_drained_in_batches(spark, places):
    for i in range(4):
        land(places, f"{i}.json", article(i))
    land(places, "broken.json", "{")
    land(places, "note.txt", "no article")
    stream(spark, places).awaitTermination()
    assert set(published(places)) == {f"{i}.json" for i in range(4)}
    first = published(places)["0.json"]
    assert [a[RESULT] for a in first["Klassifikations-Attribute"]] == ["kiste", ["#ff0000"]]
    assert sorted(os.listdir(f"{places}/out")) == ["done", "note.txt"]
    assert len(os.listdir(f"{places}/out/done")) == 5
    tables = f"{places}/tables"
    sizes = spark.read.parquet(f"{tables}/articles").groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in sizes) == [1, 2, 2]
    assert len(os.listdir(f"{places}/marks")) == 8
    assert [r["reason"] for r in spark.read.parquet(f"{tables}/quarantine").collect()] == ["invalid_json"]
    ledger = {(r["product_id"], r["supplier_colour"], r["url"]) for r in read_batches(spark, f"{tables}/failed_images").collect()}
    urls = ("http://img/2/main.jpg", "http://img/2/model.jpg")
    assert ledger == {("2", c, u) for c in (None, "F2") for u in urls}

    metrics = spark.read.parquet(f"{tables}/metrics").where("batch_id = 2")
    got = {r["metric"]: r["value"] for r in metrics.collect()}
    assert got["files"] == 1 and got["more_available"] == 0
    assert got["published_asked"] == got["published_done"] <= got["archived_done"] == 1

    # A second run takes only what arrived since; what is in the ledger is not added again.
    land(places, "late.json", article(2))
    stream(spark, places).awaitTermination()
    assert "late.json" in published(places) and len(os.listdir(f"{places}/marks")) == 10
    assert read_batches(spark, f"{tables}/failed_images").count() == len(ledger)


def test_a_failed_batch_is_run_again(spark, places):
    only_main = {"Freisteller Back": MISSING, "Modellbild": None}
    land(places, "0.json", article(0, **only_main))
    poison = f"{places}/poison"
    open(poison, "w").close()
    answerer = call_model(marking_client(f"{places}/marks", poison), on_error="fail")
    with pytest.raises(Exception, match="poisoned"):
        stream(spark, places, answerer).awaitTermination()
    assert os.listdir(f"{places}/out") == ["0.json"] and os.listdir(f"{places}/in") == []
    os.rename(poison, f"{places}/cured")
    stream(spark, places, answerer).awaitTermination()
    assert set(published(places)) == {"0.json"} and len(os.listdir(f"{places}/marks")) == 2


def test_finished_calls_are_not_repeated(spark, places):
    land(places, "0.json", article(0))
    with open(f"{places}/not a folder", "w"):
        pass
    with pytest.raises(Exception, match="not fully published"):
        stream(spark, places, outbound=f"{places}/not a folder").awaitTermination()
    calls = len(os.listdir(f"{places}/marks"))
    assert calls == 2 and os.listdir(f"{places}/out") == ["0.json"]
    stream(spark, places).awaitTermination()
    assert set(published(places)) == {"0.json"}
    assert len(os.listdir(f"{places}/marks")) == calls
    assert os.listdir(f"{places}/out") == ["done"]


def test_polling_stream_stays(spark, places):
    query = stream(spark, places, poll_seconds=1)
    land(places, "0.json", article(0))
    query.processAllAvailable()
    assert query.isActive and set(published(places)) == {"0.json"}
    query.stop()


def test_inputs_can_be_deleted(spark, places):
    land(places, "0.json", article(0))
    stream(spark, places, archive=None, delete_inputs=True).awaitTermination()
    assert set(published(places)) == {"0.json"} and os.listdir(f"{places}/out") == []


def test_tables_without_files(spark, places):
    land(places, "0.json", [article(0), article(1)])
    stream(spark, places, archive=None, outbound=None).awaitTermination()
    rows = spark.read.parquet(f"{places}/tables/published").collect()
    assert sorted((r["source_file"], r["doc_pos"]) for r in rows) == [("0.json", 0), ("0.json", 1)]
    assert os.listdir(f"{places}/out") == ["0.json"] and os.listdir(f"{places}/in") == []


def test_ledger_of_a_replayed_batch(spark, folder):
    def lines(*ids):
        return spark.createDataFrame([(i, None, "u") for i in ids], "product_id string, supplier_colour string, url string")

    path = f"{folder}/ledger"
    append_to_ledger(lines("1", "2", "1"), path, 0)
    for _ in range(2):
        append_to_ledger(lines("2", "3"), path, 1)
        assert sorted((r["batch_id"], r["product_id"]) for r in read_batches(spark, path).collect()) == [
            (0, "1"), (0, "2"), (1, "3"),
        ]


def drain(spark, places, answerer=None, **options):
    answerer = answerer or call_model(marking_client(f"{places}/marks"))
    options = {"outbound": f"{places}/in", "archive": f"{places}/done", "batch_size": 2, "validate": False, **options}
    return poll(spark, f"{places}/out", f"{places}/tables", make_fetch, answerer, **options)


def test_a_file_delivered_again_is_processed_again(spark, places):
    names = ("0.json", "a [1]{b}*?\\ü+%.json", "_hidden.json", ".dot.json")
    for name in (*names, "note.txt"):
        land(places, name, article(0))
    os.utime(f"{places}/out/0.json", (10**9, 10**9))  # an old file, moved here with its time
    land(places, "broken.json", "{")
    os.mkdir(f"{places}/out/folder.json")
    assert drain(spark, places) == Drained(3, 5, 0)
    assert sorted(os.listdir(f"{places}/out")) == ["folder.json", "note.txt"]
    assert set(published(places)) == set(names)
    land(places, "0.json", article(0, FarbID="new"))
    assert drain(spark, places) == Drained(1, 1, 0)
    assert published(places)["0.json"]["FarbID"] == "new"
    with open(f"{places}/done/0.json", encoding="utf-8") as source:
        assert json.load(source)["FarbID"] == "new"
    assert drain(spark, places, idle_checks=3, poll_seconds=0.01) == Drained(0, 0, 0)
    batches = spark.read.parquet(f"{places}/tables/metrics").where("metric = 'files'").collect()
    assert sorted((r["batch_id"], r["value"]) for r in batches) == [(0, 2), (1, 2), (2, 1), (3, 1)]


def test_polling_resumes_a_failed_batch(spark, places):
    land(places, "0.json", article(0))
    with open(f"{places}/not a folder", "w"):
        pass
    with pytest.raises(OSError, match="not fully published"):
        drain(spark, places, outbound=f"{places}/not a folder")
    land(places, "1.json", article(1))
    assert drain(spark, places, batch_size=1).batches == 2
    assert set(published(places)) == {"0.json", "1.json"}
    assert len(os.listdir(f"{places}/marks")) == 4 and os.listdir(f"{places}/out") == []


def test_files_that_stay_keep_no_others_from_their_turn(spark, places):
    for i in range(6):
        land(places, f"{i}.json", article(i % 2))
    with open(f"{places}/done", "w"):
        pass  # nothing can be moved
    assert drain(spark, places) == Drained(3, 6, 6)
    assert len(published(places)) == 6
    calls = len(os.listdir(f"{places}/marks"))
    land(places, "6.json", article(0))
    assert drain(spark, places) == Drained(1, 1, 7)
    # What was processed is not paid for again, and goes as soon as it can be moved.
    assert len(os.listdir(f"{places}/marks")) == calls + 2
    os.rename(f"{places}/done", f"{places}/was in the way")
    assert drain(spark, places) == Drained(0, 0, 0)
    assert os.listdir(f"{places}/out") == [] and len(os.listdir(f"{places}/done")) == 7


def test_a_file_that_cannot_be_read_is_told(spark, places):
    land(places, "0.json", article(0))
    os.symlink(f"{places}/nowhere", f"{places}/vanished.json")
    files = [File(f"file://{places}/out/0.json", 0, 0), File(f"file://{places}/vanished.json", 0, 0)]
    got = {r["source_file"]: r for r in read_files(spark.createDataFrame(files, FILE)).collect()}
    assert got["0.json"]["read_error"] is None
    assert got["vanished.json"]["document"] is None
    assert got["vanished.json"]["read_error"].startswith("FileNotFoundError")
    reasons = from_documents(read_files(spark.createDataFrame(files, FILE))).collect()
    assert {r["source_file"]: r["reject_reason"] for r in reasons} == {"0.json": None, "vanished.json": "unreadable"}


def test_a_file_written_again_meanwhile_is_not_archived_unread(spark, places):
    land(places, "0.json", article(0))
    (listed,) = list_files(spark, f"{places}/out")
    land(places, "0.json", article(0, FarbID="newer"))
    os.utime(f"{places}/out/0.json", (10**9, 10**9))
    (moved,) = archive_files(spark.createDataFrame([listed], FILE), f"{places}/done").collect()
    assert not moved["done"] and "written again" in moved["error"]
    assert os.listdir(f"{places}/out") == ["0.json"]


def test_the_next_batch_is_found_without_a_listing(spark, folder):
    for n in range(6):
        assert _next_batch(spark, f"{folder}/t") == n
        os.makedirs(f"{folder}/t/metrics/batch_id={n}")
        open(f"{folder}/t/metrics/batch_id={n}/_SUCCESS", "w").close()


def test_polling_needs_a_place_for_its_inputs(spark, places):
    with pytest.raises(ValueError):
        drain(spark, places, archive=None)
