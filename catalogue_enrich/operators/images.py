"""Images of articles: join to the fetched images and the three-way branch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import IMAGE_KEYS
from .normalize import explode_images
from .skew import join_counted


def attach_images(
    articles: DataFrame, images: DataFrame, with_content: bool = False
) -> DataFrame:
    """Add ``images``: ``array<struct<pos, url, ok[, content]>>`` in image order.

    ``images`` is ``url, n_uses, ok[, content]`` with one row per URL; a URL it lacks
    counts as failed. References (not documents) are shuffled by URL, then by article; the
    bytes travel once per article image, not once per attribute, and only with
    ``with_content``.
    """
    return with_slots(articles, image_slots(articles, images, with_content), with_content)


# An article has one image per key, so a fixed number of slots holds them all and
# nothing is collected.
_SLOTS = [f"_image{i}" for i in range(len(IMAGE_KEYS))]


def image_slots(articles: DataFrame, images: DataFrame, with_content: bool = False) -> DataFrame:
    """The images found, one row per article: ``article_key`` and a slot per image key."""
    # image_list makes at most one URL per image key.
    columns = ["url", "n_uses", "ok"] + (["content"] if with_content else [])
    refs = explode_images(articles, "article_key")
    found = join_counted(refs, images.select(*columns), "url", "n_uses", F.col("article_key"))
    if with_content:
        # One row per image: there is nothing to combine before the shuffle, and sorting
        # the bytes on both sides of it would be for nothing.
        found = found.repartition("article_key")
    # Flags alone are combined by hash; bytes are sorted once.
    picked = F.struct("ok", "content") if with_content else F.col("ok")
    return found.groupBy("article_key").agg(
        *(F.max(F.when(F.col("pos") == i, picked)).alias(slot) for i, slot in enumerate(_SLOTS))
    )


def with_slots(articles: DataFrame, slots: DataFrame, with_content: bool = False) -> DataFrame:
    """Add ``images``, as ``attach_images`` does, from what ``image_slots`` found."""

    def image(url: Column, i: Column) -> Column:
        slot = F.get(F.array(*_SLOTS), i)
        fields = [i.cast("int").alias("pos"), url.alias("url")]
        if not with_content:
            return F.struct(*fields, F.coalesce(slot, F.lit(False)).alias("ok"))
        ok = F.coalesce(slot["ok"], F.lit(False))
        return F.struct(*fields, ok.alias("ok"), slot["content"].alias("content"))

    return (
        articles.join(slots, "article_key", "left")
        .withColumn("images", F.transform("image_urls", image))
        .drop(*_SLOTS)
    )


def ok_images(images: str = "images") -> Column:
    """The images that were fetched, in order."""
    return F.filter(images, lambda i: i["ok"])


def branch(image_urls: str = "image_urls", images: str = "images") -> Column:
    """What happens to the results of an article.

    ``kept``: it names no image, the results stay as they are. ``nulled``: every image
    failed, the results are overwritten with null. ``inferred``: the model is asked.
    """
    return (
        F.when(F.size(image_urls) == 0, F.lit("kept"))
        .when(F.size(ok_images(images)) == 0, F.lit("nulled"))
        .otherwise(F.lit("inferred"))
    )
