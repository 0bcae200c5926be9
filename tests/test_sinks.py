import json
import os

import pytest
from pyarrow import fs as arrow_fs
from pyspark.sql import functions as F

from catalogue_enrich.sinks import (
    archive_files,
    delete_files,
    last_writes,
    place_files,
    publish_dataset,
    publish_files,
    replace_file,
    restore_replaced,
    stage_files,
    staging,
)
from catalogue_enrich.sources.batches import assign_batches, batch_report
from catalogue_enrich.sources.landing import read_landing
from tests.articles import article


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)


def read(path):
    with open(path, encoding="utf-8") as source:
        return source.read()


def test_files_are_written_like_a_json_dump(spark, folder):
    documents = {"a ü.json": article(1, x="ü", y=None, z=[1.5, {}]), "b.json": article(2)}
    rows = [(name, None, json.dumps(d)) for name, d in documents.items()]
    rows += [("list.json", 0, '{"n": 0}'), ("list.json", 1, '{"n": 1}')]
    frame = spark.createDataFrame(rows, "source_file string, doc_pos int, enriched string")
    write(f"{folder}/in/b.json", "old")
    for _ in range(2):  # again: nothing changes
        report = publish_files(frame, f"{folder}/in").collect()
        assert all(r["done"] for r in report) and len(report) == 4
        for name, document in documents.items():
            assert read(f"{folder}/in/{name}") == json.dumps(document, indent=2, ensure_ascii=False)
        assert sorted(os.listdir(f"{folder}/in")) == ["a ü.json", "b.json", "list.json.d"]
        assert sorted(os.listdir(f"{folder}/in/list.json.d")) == ["0.json", "1.json"]


def test_a_file_that_cannot_be_written_is_reported(spark, folder):
    write(f"{folder}/in", "a file where the folder should be")
    frame = spark.createDataFrame([("a.json", None, "{}")], "source_file string, doc_pos int, enriched string")
    report = publish_files(frame, f"{folder}/in").first()
    assert not report["done"] and report["error"]


class Stopped(Exception):
    pass


class StrictStore:
    """A store that does not move over a file, and that stops before its n-th change."""

    def __init__(self, changes):
        self.files, self.left = arrow_fs.LocalFileSystem(), changes

    def get_file_info(self, what):
        return self.files.get_file_info(what)

    def change(self):
        if not self.left:
            raise Stopped
        self.left -= 1

    def move(self, source, target):
        if os.path.exists(target):
            raise OSError("there is a file")
        self.change()
        self.files.move(source, target)

    def delete_file(self, path):
        self.change()
        self.files.delete_file(path)


@pytest.mark.parametrize("stop", range(4))
def test_a_name_is_never_lost(folder, stop):
    write(f"{folder}/a.json", "old")
    write(f"{folder}/.new", "new")
    try:
        replace_file(StrictStore(stop), f"{folder}/.new", f"{folder}/a.json")
    except Stopped:
        assert stop < 3
    files = arrow_fs.LocalFileSystem()
    restore_replaced(files, folder)
    assert read(f"{folder}/a.json") == ("new" if stop >= 2 else "old")
    if stop < 2:
        replace_file(StrictStore(9), f"{folder}/.new", f"{folder}/a.json")
    assert read(f"{folder}/a.json") == "new" and os.listdir(folder) == ["a.json"]


@pytest.mark.parametrize("placed", range(4))
def test_a_batch_gets_its_names_after_its_manifest(spark, folder, placed):
    rows = [(f"{i}.json", None, json.dumps({"n": i})) for i in range(2)] + [("l.json", 0, "{}")]
    frame = spark.createDataFrame(rows, "source_file string, doc_pos int, enriched string")
    write(f"{folder}/in/0.json", "old")
    stage_files(frame, f"{folder}/in", 5).write.parquet(f"{folder}/manifest")
    assert sorted(os.listdir(f"{folder}/in")) == [".batch-5", "0.json"] and read(f"{folder}/in/0.json") == "old"
    manifest = spark.read.parquet(f"{folder}/manifest")
    # Stopped after some moves; a file that got its name may have been taken.
    for name in ["0.json", "1.json", "l.json.d/0.json"][:placed]:
        os.makedirs(os.path.dirname(f"{folder}/in/{name}"), exist_ok=True)
        os.replace(f"{staging(f'{folder}/in', 5)}/{name}", f"{folder}/in/{name}")
    if placed == 3:
        os.remove(f"{folder}/in/1.json")
    report = place_files(manifest, f"{folder}/in", 5).collect()
    assert len(report) == 3 and all(r["done"] for r in report)
    assert json.loads(read(f"{folder}/in/0.json")) == {"n": 0}
    assert os.path.exists(f"{folder}/in/1.json") == (placed < 3)
    assert os.path.exists(f"{folder}/in/l.json.d/0.json")


def test_archive(spark, folder):
    for name in ("a ü+%.json", "b.json", "c.json"):
        write(f"{folder}/out/{name}", f"new {name}")
    write(f"{folder}/out/done/b.json", "old")
    listed = read_landing(spark, f"{folder}/out")
    processed = spark.createDataFrame([("a ü+%.json",), ("b.json",), ("b.json",), ("gone.json",)], "source_file string")
    # Only listed files that were processed, each once.
    mine = listed.join(processed, "source_file", "left_semi")
    paths = spark.createDataFrame([(r["source_path"],) for r in mine.collect()], "source_path string")
    for _ in range(2):  # the replay finds them moved already
        report = archive_files(paths.union(paths), f"{folder}/out/done").collect()
        assert len(report) == 2 and all(r["done"] for r in report)
        assert sorted(os.listdir(f"{folder}/out")) == ["c.json", "done"]
        assert read(f"{folder}/out/done/b.json") == "new b.json"
        assert read(f"{folder}/out/done/a ü+%.json") == "new a ü+%.json"
    absent = spark.createDataFrame([(f"file://{folder}/out/absent.json",)], "source_path string")
    report = archive_files(absent, f"{folder}/out/done").first()
    assert not report["done"] and report["error"]


def test_delete(spark, folder):
    write(f"{folder}/out/a.json", "x")
    paths = spark.createDataFrame(
        [(f"file://{folder}/out/a.json",), (f"file://{folder}/out/absent.json",)], "source_path string"
    )
    report = {r["path"].rsplit("/", 1)[1]: r["done"] for r in delete_files(paths).collect()}
    assert report == {"a.json": True, "absent.json": False}
    assert os.listdir(f"{folder}/out") == []


def test_publishing_a_batch_again_replaces_it(spark, folder):
    for rows in (["a", "b"], ["a"], []):
        publish_dataset(spark.createDataFrame([(r,) for r in rows], "v string"), f"{folder}/t", 3)
        publish_dataset(spark.createDataFrame([("x",)], "v string"), f"{folder}/t", 4)
        got = {(r["batch_id"], r["v"]) for r in spark.read.parquet(f"{folder}/t").collect()}
        assert got == {(3, r) for r in rows} | {(4, "x")}


def test_batches_follow_the_order(spark):
    n, size = 1003, 100
    names = spark.range(n).select(F.format_string("f%05d", F.col("id")).alias("name")).orderBy(F.xxhash64("name"))
    batched = assign_batches(names.repartition(7), "name", size)
    got = {r["name"]: r["batch"] for r in batched.collect()}
    assert got == {f"f{i:05d}": i // size for i in range(n)}
    report = {r["batch"]: (r["n"], r["more_available"]) for r in batch_report(batched, size).collect()}
    assert report == {i: (100, True) for i in range(10)} | {10: (3, False)}
    assert assign_batches(names.where("false"), "name", size).count() == 0


def test_the_last_write_wins(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, None)], "name string, n int, v string")
    assert {tuple(r) for r in last_writes(rows, ["name"], "n").collect()} == {("a", 3, "y"), ("b", 1, None)}
