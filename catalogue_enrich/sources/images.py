"""Images: fetch once per distinct URL (S6, U5) and probe decoded images."""

from __future__ import annotations

import http.client
import ssl
import time
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import thumbnail_size
from .whole_image import whole_image

Fetch = Callable[[str], bytes]

FETCHED = "url string, n_uses bigint, ok boolean, content binary, error string"

# Rows per output frame: bounds the image bytes a worker holds.
_FRAME_ROWS = 32


def url_registry(articles: DataFrame) -> DataFrame:
    """Distinct image URLs with ``n_uses``, the number of article images that name them.

    Counts are combined before the shuffle, so a URL used everywhere costs one row per task.
    """
    return (
        articles.select(F.explode("image_urls").alias("url"))
        .groupBy("url")
        .agg(F.count("*").alias("n_uses"))
    )


def http_get(timeout: float = 5, verify_certificate: bool = True) -> Fetch:
    """A fetch function for ``http`` and ``https``, also after redirects.

    A document names its images, so no other scheme is opened: a ``file:`` URL would read
    what lies on the executor.
    """
    context = None if verify_certificate else ssl._create_unverified_context()
    opener = urllib.request.OpenerDirector()
    for handler in (
        urllib.request.ProxyHandler(),
        urllib.request.HTTPHandler(),
        urllib.request.HTTPSHandler(context=context),
        urllib.request.HTTPRedirectHandler(),
        urllib.request.HTTPDefaultErrorHandler(),
        urllib.request.HTTPErrorProcessor(),
        urllib.request.UnknownHandler(),
    ):
        opener.add_handler(handler)

    def fetch(url: str) -> bytes:
        with opener.open(url, timeout=timeout) as reply:
            return reply.read()

    return fetch


def fetch_images(
    registry: DataFrame,
    make_fetch: Callable[[], Fetch],
    *,
    prepare: Callable[[bytes], bytes] | None = None,
    attempts: int = 1,
    pause: float = 1.0,
    retry_on: tuple[type[BaseException], ...] = (OSError, http.client.HTTPException),
    validate: bool = True,
    parallelism: int | None = None,
    concurrency: int = 1,
) -> DataFrame:
    """Fetch every URL of ``registry`` once: ``url, n_uses, ok, content, error``.

    ``make_fetch`` runs once per task and may open a client. A transport error
    (``retry_on``) is tried ``attempts`` times, ``pause`` seconds apart. Any other error,
    and any error of ``prepare`` (convert, shrink), fails the URL at once; so does, unless
    ``validate`` is off, content that is not a whole image (``sources.whole_image``).
    A failed URL is a row with ``ok`` false, never an exception. ``parallelism`` sets the
    number of fetch tasks and ``concurrency`` the fetches under way in each. Stage the
    result (``session.stage``) before it is used more than once.
    """

    def fetch_one(fetch: Fetch, url: str) -> tuple[bool, bytes | None, str | None]:
        error = "no attempt was made"
        for attempt in range(attempts):
            if attempt:
                time.sleep(pause)
            try:
                content = fetch(url)
            except retry_on as failure:
                error = f"{type(failure).__name__}: {failure}"
                continue
            except Exception as failure:
                return False, None, f"{type(failure).__name__}: {failure}"
            try:
                if validate:
                    whole_image(content)
                return True, prepare(content) if prepare else content, None
            except Exception as failure:
                return False, None, f"{type(failure).__name__}: {failure}"
        return False, None, error

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetch = make_fetch()
        with ThreadPoolExecutor(concurrency) as pool:
            for frame in frames:
                for start in range(0, len(frame), _FRAME_ROWS):
                    part = frame.iloc[start : start + _FRAME_ROWS]
                    fetched = list(pool.map(partial(fetch_one, fetch), part["url"]))
                    yield pd.DataFrame(
                        {
                            "url": part["url"].to_numpy(),
                            "n_uses": part["n_uses"].to_numpy(),
                            "ok": [ok for ok, _, _ in fetched],
                            "content": [content for _, content, _ in fetched],
                            "error": [error for _, _, error in fetched],
                        }
                    )

    # The registry is small in bytes but slow to fetch, so its partitions are set by
    # count: AQE would merge them by size into a few tasks.
    n = parallelism or int(registry.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return registry.select("url", "n_uses").repartition(n, "url").mapInPandas(run, FETCHED)


def probe_images(spark: SparkSession, path: str) -> DataFrame:
    """Decode the images in ``path``: ``url, ok, width, height, needs_rgb, out``.

    ``out`` is the thumbnail size; ``needs_rgb`` says that the image has other than the
    three colour channels.
    """
    image = F.col("image")
    ok = image["width"] > 0
    return (
        spark.read.format("image")
        .option("dropInvalid", "false")
        .load(path)
        .select(
            image["origin"].alias("url"),
            ok.alias("ok"),
            F.when(ok, image["width"]).alias("width"),
            F.when(ok, image["height"]).alias("height"),
            F.when(ok, image["nChannels"] != 3).alias("needs_rgb"),
            F.when(ok, thumbnail_size(image["width"], image["height"])).alias("out"),
        )
    )
