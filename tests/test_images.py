import struct
import zlib

import pytest
from pyspark.sql import functions as F

from catalogue_enrich.operators.images import attach_images, branch
from catalogue_enrich.operators.ledger import as_text, failed_lines, new_lines
from catalogue_enrich.operators.normalize import from_documents
from catalogue_enrich.operators.skew import join_counted, spread
from catalogue_enrich.sources.images import fetch_images, http_get, probe_images, url_registry
from catalogue_enrich.sources.media import NotAnImage, image_header, probe
from catalogue_enrich.sources.whole_image import whole_image
from tests.articles import MISSING, article, attribute, raw


def png(width, height, channels=3):
    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    header = struct.pack(">IIBBBBB", width, height, 8, {3: 2, 4: 6}[channels], 0, 0, 0)
    lines = b"".join(b"\0" + bytes(width * channels) for _ in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def test_probe(spark, folder):
    images = {"wide.png": png(1000, 400), "alpha.png": png(30, 40, 4), "box.png": png(500, 500), "flat.png": png(5000, 3)}
    images["junk.png"] = b"no image"
    for name, content in images.items():
        with open(f"{folder}/{name}", "wb") as out:
            out.write(content)
    got = {
        r["url"].rsplit("/", 1)[1]: (r["ok"], r["needs_rgb"], tuple(r["out"]) if r["out"] else None)
        for r in probe_images(spark, folder).collect()
    }
    assert got == {
        "wide.png": (True, False, (500, 200)),
        "alpha.png": (True, True, (30, 40)),
        "box.png": (True, False, (500, 500)),
        "flat.png": (True, False, (500, 1)),
        "junk.png": (False, None, None),
    }


def count_calls(folder):
    """A fetch that leaves a mark per call, as the calls happen in other processes."""

    def make():
        import uuid

        def fetch(url):
            name = url.rsplit("/", 1)[1]
            open(f"{folder}/{name}.{uuid.uuid4().hex}", "w").close()
            if name.startswith("down"):
                raise OSError("down")
            if name.startswith("bad"):
                raise ValueError("bad")
            return name.encode()

        return fetch

    return make


def calls(folder, name):
    import os

    return sum(f.startswith(f"{name}.") for f in os.listdir(folder))


@pytest.mark.parametrize("concurrency", [1, 4])
def test_fetch_once_per_url_and_retry(spark, folder, concurrency):
    urls = ["http://h/ok"] * 50 + ["http://h/down", "http://h/bad", "http://h/broken", "http://h/ok2"]
    rows = spark.createDataFrame([([u],) for u in urls], "image_urls array<string>")

    def prepare(content):
        if content == b"broken":
            raise ValueError("cannot decode")
        return content * 2

    options = {"validate": False, "prepare": prepare, "attempts": 3, "pause": 0.01, "concurrency": concurrency}
    fetched = fetch_images(url_registry(rows), count_calls(folder), **options)
    got = {r["url"].rsplit("/", 1)[1]: r for r in fetched.collect()}
    assert got["ok"]["n_uses"] == 50 and bytes(got["ok"]["content"]) == b"okok" and got["ok"]["error"] is None
    assert [got[n]["ok"] for n in ("ok", "ok2", "down", "bad", "broken")] == [True, True, False, False, False]
    assert got["down"]["error"] == "OSError: down" and got["broken"]["error"] == "ValueError: cannot decode"
    assert [calls(folder, n) for n in ("ok", "ok2", "down", "bad", "broken")] == [1, 1, 3, 1, 1]


@pytest.mark.parametrize("url", ["file:///etc/hostname", "ftp://h/x", "data:,x", "nonsense"])
def test_http_get_opens_nothing_else(url):
    with pytest.raises((OSError, ValueError)):
        http_get()(url)


def png_header(width, height, colour=2):
    header = struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + header + b"rest"


JPEG = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x20\x00\x40\x03rest of the frame"
IMAGES = [
    (png_header(1000, 400), ("image/png", 1000, 400, 3)),
    (png_header(30, 40, 6), ("image/png", 30, 40, 4)),
    (JPEG, ("image/jpeg", 64, 32, 3)),
    (b"GIF89a" + struct.pack("<HH", 7, 9), ("image/gif", 7, 9, 3)),
    (b"BM" + bytes(16) + struct.pack("<iiHH", 5, -6, 1, 32), ("image/bmp", 5, 6, 4)),
    (b"RIFFsizeWEBPVP8X" + bytes(4) + b"\x10" + bytes(3) + b"\x09\x00\x00\x13\x00\x00", ("image/webp", 10, 20, 4)),
]


@pytest.mark.parametrize("content, want", IMAGES)
def test_headers(content, want):
    found = image_header(content)
    assert (found.media_type, found.width, found.height, found.channels) == want
    for end in range(0, 16):
        with pytest.raises(NotAnImage):
            image_header(content[:end] if want[0] != "image/gif" else content[: min(end, 9)])


@pytest.mark.parametrize("junk", [b"", b"<html>no image</html>", png_header(0, 5), JPEG[:8] + b"\xff\xda", b"\x89PNG"])
def test_junk_is_no_image(junk):
    with pytest.raises(NotAnImage):
        image_header(junk)


def test_junk_counts_as_a_failed_image(spark):
    def make():
        return lambda url: b"<html>" if "junk" in url else png(1000, 400)

    rows = spark.createDataFrame([(["http://h/junk", "http://h/ok"],)], "image_urls array<string>")
    fetched = fetch_images(url_registry(rows), make)
    got = {r["url"]: r for r in fetched.select("url", "ok", "error", probe("content").alias("p")).collect()}
    assert not got["http://h/junk"]["ok"] and got["http://h/junk"]["error"].startswith("NotAnImage")
    assert got["http://h/junk"]["p"]["width"] is None
    assert got["http://h/ok"]["p"].asDict(True) == {
        "media_type": "image/png", "width": 1000, "height": 400, "needs_rgb": False, "out": {"width": 500, "height": 200},
    }


def segment(marker, data):
    return bytes([0xFF, marker]) + struct.pack(">H", len(data) + 2) + data


def webp(*chunks):
    body = b"WEBP" + b"".join(k + struct.pack("<I", len(d)) + d + bytes(len(d) % 2) for k, d in chunks)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def interlaced(width, height):
    """A grey PNG in seven passes, of one bit a pixel."""
    whole = png(1, 1)
    lines = b"".join(
        bytes(1 + (-(-(width - a) // c) + 7) // 8) * -(-(height - b) // d)
        for a, b, c, d in ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))
        if a < width and b < height
    )

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">IIBBBBB", width, height, 1, 0, 0, 0, 1)
    packed = zlib.compress(lines)
    # The data may be cut into chunks anywhere.
    parts = b"".join(chunk(b"IDAT", packed[i : i + 5]) for i in range(0, len(packed), 5))
    return whole[:8] + chunk(b"IHDR", header) + parts + chunk(b"IEND", b"")


FRAME = segment(0xC0, b"\x08\x00\x20\x00\x40\x03" + bytes(9))
SCAN = segment(0xDA, b"\x03" + bytes(9)) + b"\x12\xff\x00\x34\xff\xd0\x56"
GIF = b"GIF89a" + struct.pack("<HHBBB", 7, 9, 0x80, 0, 0) + bytes(6)
GIF += b"!\xf9\x04\x00\x00\x00\x00\x00," + struct.pack("<HHHHB", 0, 0, 7, 9, 0) + b"\x02\x03\x84\x8f\x05\x00;"
KEY_FRAME = struct.pack("<I", 4 << 5)[:3] + b"\x9d\x01\x2a" + struct.pack("<HH", 7, 9) + b"abcdef"
WHOLE = {
    "png": png(40, 30),
    "alpha": png(300, 200, 4),
    "interlaced": interlaced(13, 11),
    "small interlaced": interlaced(1, 1),
    "jpeg": b"\xff\xd8" + segment(0xE0, b"JFIF") + FRAME + SCAN + b"\xff\xd9",
    "progressive": b"\xff\xd8\xff" + FRAME + SCAN + segment(0xC4, b"x") + SCAN + b"\xff\xff\xd9",
    "gif": GIF,
    "bmp": b"BM" + struct.pack("<IHHIIiiHHII", 94, 0, 0, 54, 40, 5, -2, 1, 32, 0, 40) + bytes(56),
    "webp": webp((b"VP8 ", KEY_FRAME)),
    "lossless": webp((b"VP8L", b"\x2f\x06\x00\x02\x00abc")),
    "animated": webp(
        (b"VP8X", b"\x12" + bytes(9)), (b"ANIM", bytes(6)), (b"ANMF", bytes(16) + webp((b"VP8 ", KEY_FRAME))[12:])
    ),
}


@pytest.mark.parametrize("kind", WHOLE)
def test_an_image_is_whole_or_none(kind):
    content = WHOLE[kind]
    assert whole_image(content) == image_header(content) == whole_image(content + b"more")
    for end in range(0, len(content) - (16 if kind == "bmp" else 0)):
        with pytest.raises(NotAnImage):
            whole_image(content[:end])


@pytest.mark.parametrize("kind", ["png", "interlaced"])
def test_a_turned_bit_is_found(kind):
    content = WHOLE[kind]
    for at in range(8, len(content)):
        with pytest.raises(NotAnImage):
            whole_image(content[:at] + bytes([content[at] ^ 16]) + content[at + 1 :])


def test_missing_lines_are_found():
    short, tall = png(40, 29), png(40, 30)
    with pytest.raises(NotAnImage, match="lines"):
        whole_image(tall[:33] + short[33:])
    assert whole_image(short[:33] + tall[33:]).height == 29  # more lines than are needed
    # Images that inflate to far more than they hold are not inflated to their end.
    bomb = zlib.compress(bytes(200_000_000))
    data = struct.pack(">I", len(bomb)) + b"IDAT" + bomb + struct.pack(">I", zlib.crc32(b"IDAT" + bomb))
    assert whole_image(tall[:33] + data + tall[-12:]).width == 40


def test_truncated_images_count_as_failed(spark):
    def make():
        return lambda url: WHOLE[url[9:]][: -1 if "gif" in url else None]

    rows = spark.createDataFrame([(["http://h/gif", "http://h/jpeg"],)], "image_urls array<string>")
    got = {r["url"]: r for r in fetch_images(url_registry(rows), make).collect()}
    assert got["http://h/jpeg"]["ok"] and not got["http://h/gif"]["ok"]
    assert "cut off" in got["http://h/gif"]["error"]


def article_rows(spark, *documents):
    return from_documents(raw(spark, [(f"{i}.json", d) for i, d in enumerate(documents)]))


def images_of(spark, rows, failing=()):
    return url_registry(rows).withColumn("ok", ~F.col("url").isin(list(failing) or [""])).withColumn(
        "content", F.when(F.col("ok"), F.encode("url", "UTF-8"))
    )


@pytest.mark.parametrize("with_content", [False, True])
def test_branches(spark, with_content):
    only_main = {"Freisteller Back": MISSING, "Modellbild": None}
    rows = article_rows(
        spark,
        article(0),
        article(1, **only_main),
        article(2, Hauptbild="", **only_main),
        article(3, Hauptbild="http://img/shared/back.jpg"),
    )
    images = images_of(spark, rows, ["http://img/0/main.jpg", "http://img/1/main.jpg"])
    images = images.where(F.col("url") != "http://img/3/model.jpg")  # never fetched: counts as failed
    joined = attach_images(rows, images, with_content).withColumn("branch", branch())
    got = {r["product_id"]: r for r in joined.collect()}
    assert {k: r["branch"] for k, r in got.items()} == {"0": "inferred", "1": "nulled", "2": "kept", "3": "inferred"}
    assert [i["ok"] for i in got["0"]["images"]] == [False, True, True]
    assert [(i["pos"], i["url"], i["ok"]) for i in got["3"]["images"]] == [
        (0, "http://img/shared/back.jpg", True),
        (1, "http://img/shared/back.jpg", True),
        (2, "http://img/3/model.jpg", False),
    ]
    if with_content:
        assert [i["content"] and bytes(i["content"]) for i in got["0"]["images"]] == [
            None, b"http://img/shared/back.jpg", b"http://img/0/model.jpg",
        ]


def test_a_hot_url_is_spread(spark):
    n = 3000
    many = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("hot").alias("url"))
    one = many.groupBy("url").agg(F.count("*").alias("n")).withColumn("ok", F.lit(True))
    joined = join_counted(many, one.where("url <> '3'"), "url", "n", F.col("id"), slices=16)
    assert joined.count() == n
    assert joined.where("ok").count() == n - 1
    assert sorted(r["id"] for r in joined.select("id").collect()) == list(range(n))
    placed, repeated = spread(many, one, "url", "n", F.col("id"), slices=16)
    largest = placed.groupBy("url", "_slice").count().agg(F.max("count")).first()[0]
    assert largest < 1.5 * n / 16  # the hot key alone has 2/3 of all rows
    assert repeated.count() <= one.count() + 2 * 16


def test_ledger(spark):
    attributes = [attribute("x"), attribute("farbe"), attribute("y")]
    none = {"Hauptbild": "", "Freisteller Back": None, "Modellbild": MISSING}
    rows = article_rows(
        spark,
        article(1, **{"Klassifikations-Attribute": attributes}),
        article(2, **{"Klassifikations-Attribute": attributes[:1]}),
        article(3, **none),
        article(4, **{"Klassifikations-Attribute": []}, **none),
        article(5, **{"Klassifikations-Attribute": []}),
        article(3, **none),
    )
    failing = ["http://img/shared/back.jpg", "http://img/5/main.jpg"]
    lines = failed_lines(attach_images(rows, images_of(spark, rows, failing)))
    assert sorted(r[0] for r in as_text(lines).collect()) == [
        "1,F1,http://img/shared/back.jpg",
        "1,None,http://img/shared/back.jpg",
        "2,None,http://img/shared/back.jpg",
        "3,F3,[]",
    ]
    held = lines.where("product_id = '1'")
    fresh = new_lines(lines.union(lines), held)
    assert sorted(r[0] for r in as_text(fresh).collect()) == ["2,None,http://img/shared/back.jpg", "3,F3,[]"]
    assert new_lines(lines, lines).count() == 0
    assert new_lines(lines, lines.where("false")).count() == 4
