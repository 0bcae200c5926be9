"""Documents to article rows (P1-P7, P11, F1-F3), with bad documents set apart.

An article row is ``article_key, source_path, source_file, doc_pos, document, product_id,
colour_id, target_group, product_category, image_urls, attributes, reject_reason``, where
``attributes`` keeps the document's order and holds, per attribute, ``pos, attribute_id,
label, orientation, options, result``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.json_text import (
    OBJECT,
    OBJECTS,
    TYPED_OBJECTS,
    bind,
    members,
    object_text,
    read_json,
    starts_with,
)

# What is read of a document: categories as maps, as it matters whether their label is there.
_END = "end of frame"
_READ = T.StructType(
    [f for f in S.ARTICLE if f.name not in (S.SUPPLIER_ARTICLE, S.CATEGORIES, S.ATTRIBUTES)]
    + [
        T.StructField(S.CATEGORIES, T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
        T.StructField(S.ATTRIBUTES, T.ArrayType(S.READ_ATTRIBUTE)),
        T.StructField(_END, T.StringType()),
    ]
)

# Stands for a missing id while options are keyed; no JSON document needs a NUL in an id.
_NO_ID = "\0"


def image_list(*urls: Column) -> Column:
    """The URLs that are neither null nor empty, in order, duplicates kept."""
    return F.filter(F.array(*urls), lambda u: u.isNotNull() & (u != ""))


def option_list(pairs: Column) -> Column:
    """Ordered options from ``array<struct<id, label>>``.

    Keyed as a dict literal is: of equal ids the first keeps its place and the last gives
    the label (needs ``mapKeyDedupPolicy=LAST_WIN``, see ``session``).
    """
    keyed = F.map_from_entries(
        F.transform(
            pairs,
            lambda p: F.struct(
                F.coalesce(p["id"], F.lit(_NO_ID)).alias("key"), p["label"].alias("value")
            ),
        )
    )
    return F.transform(
        F.map_entries(keyed),
        lambda e: F.struct(
            F.when(e["key"] != _NO_ID, e["key"]).alias("id"), e["value"].alias("label")
        ),
    )


def _article(root: Callable[[str], Column]) -> list[Column]:
    """The fields of an article row from a document's fields."""

    def attribute(a: Column, i: Column) -> Column:
        pairs = F.transform(
            F.coalesce(a[S.OPTIONS], F.array()),
            lambda o: F.struct(o[S.IDENTIFIER].alias("id"), o[S.LABEL].alias("label")),
        )
        has_options = ~a[S.IDENTIFIER].eqNullSafe(S.HEX_ATTRIBUTE)
        return F.struct(
            i.cast("int").alias("pos"),
            a[S.IDENTIFIER].alias("attribute_id"),
            a[S.LABEL].alias("label"),
            a[S.ORIENTATION].alias("orientation"),
            F.when(has_options, option_list(pairs)).alias("options"),
            a[S.RESULT].alias("result"),
        )

    return [
        root(S.PRODUCT_ID).alias("product_id"),
        root(S.COLOUR_ID).alias("colour_id"),
        root(S.TARGET_GROUP).alias("target_group"),
        F.get(root(S.CATEGORIES), F.lit(0))[S.CATEGORY_LABEL].alias("product_category"),
        image_list(*(root(k) for k in S.IMAGE_KEYS)).alias("image_urls"),
        F.transform(F.coalesce(root(S.ATTRIBUTES), F.array()), attribute).alias("attributes"),
    ]


def from_struct(articles: DataFrame, key: str | list[str]) -> DataFrame:
    """Article rows from documents held as structs (``schema.ARTICLE``).

    ``key`` names the columns that tell the documents apart. A product comes in several
    colours, so its id alone is no key where they are documents of their own.
    """

    def root(name: str) -> Column:
        return F.col(f"`{name}`")

    if isinstance(key, str):
        article_key = root(key)
    else:
        article_key = F.to_json(F.array(*(root(name).cast("string") for name in key)))
    return articles.select(article_key.alias("article_key"), *_article(root))


def _objects(document: Column) -> Column:
    """The objects of a document (one, or those of an array root); null if it is not JSON.

    The JSON reader stops after the first value, so the text is put into a frame whose end
    is only found if nothing but white space follows the value.
    """
    end = f',[{{"{_END}":"1"}}]]'
    framed = F.when(
        starts_with(document, "["), F.concat(F.lit("["), document, F.lit(end))
    ).otherwise(F.concat(F.lit("[["), document, F.lit("]" + end)))

    def unframe(items: Column) -> Column:
        found = F.get(items, F.lit(0))
        complete = (
            (F.size(items) == 2)
            & F.get(F.get(items, F.lit(1)), F.lit(0))[_END].isNotNull()
            & (starts_with(document, "[") | (F.size(found) == 1))
        )
        return F.when(complete, found)

    return bind(read_json(framed, T.ArrayType(T.ArrayType(_READ))), unframe)


def split_documents(raw: DataFrame) -> DataFrame:
    """One row per article: ``article_key, source_path, source_file, doc_pos, document, article,
    is_empty, read_error``.

    A file holds one article or an array of articles. ``document`` is the article's own
    text and ``article`` the fields enrichment reads; a reader that has taken the array apart gives
    ``doc_pos`` itself. ``article`` is null if the file is not
    valid JSON or holds anything but objects, or, with ``is_empty``, an array of none. ``source_path`` must tell the files apart.
    """
    document, objects = F.col("document"), F.col("_objects")
    if "read_error" not in raw.columns:
        raw = raw.withColumn("read_error", F.lit(None).cast("string"))
    if "doc_pos" not in raw.columns:
        raw = raw.withColumn("doc_pos", F.lit(None).cast("int"))
    listed = raw.withColumn("_objects", _objects(document))
    is_list = objects.isNotNull() & starts_with(document, "[")

    def item(text: Column, article: Column) -> Column:
        return F.struct(text.alias("document"), article.alias("article"))

    # Each article takes its own text along; the whole array is held once per file.
    texts = F.zip_with(
        read_json(document, OBJECTS),
        read_json(document, TYPED_OBJECTS),
        lambda strings, typed: object_text(members(strings, typed)),
    )
    items = F.when(is_list & (F.size(objects) > 0), F.zip_with(texts, objects, item)).otherwise(
        F.array(item(document, F.get(objects, F.lit(0))))
    )
    rows = listed.select(
        "source_path",
        "source_file",
        "read_error",
        "doc_pos",
        (is_list & (F.size(objects) > 0)).alias("_in_list"),
        (is_list & (F.size(objects) == 0)).alias("is_empty"),
        F.posexplode(items).alias("_pos", "_item"),
    )
    known = F.col("_item.article").isNotNull()
    place = F.coalesce("doc_pos", F.when(F.col("_in_list"), F.col("_pos")))
    return rows.select(
        F.concat_ws("#", "source_path", F.coalesce(place, F.when(known, F.col("_pos")))).alias("article_key"),
        "source_path",
        "source_file",
        place.alias("doc_pos"),
        "_item.document",
        "_item.article",
        "is_empty",
        "read_error",
    )


def from_documents(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Article rows from raw JSON text; see ``split_documents`` for the accepted files.

    ``reject_reason`` is set for a file that could not be read (``read_error`` of the reader), for
    a document that is not JSON and, if ``strict``, for one
    that lacks what enrichment needs. If not ``strict``, a missing category or result reads
    as null and missing attributes or options as empty.
    """
    article = F.col("article")
    attributes = article[S.ATTRIBUTES]
    category = F.get(article[S.CATEGORIES], F.lit(0))
    urls = image_list(*(article[k] for k in S.IMAGE_KEYS))

    def lacks_options(a: Column) -> Column:
        values = a[S.OPTIONS]
        no_values = values.isNull() | F.exists(values, lambda v: v.isNull())
        return ~a[S.IDENTIFIER].eqNullSafe(S.HEX_ATTRIBUTE) & no_values

    # Whether a key is missing or null shows only in the text; it is read again for the few
    # documents where that matters.
    fields = read_json(F.col("document"), OBJECT)
    no_result = (F.size(urls) == 0) & F.exists(attributes, lambda a: a[S.RESULT].isNull())
    lacks_result = F.exists(
        read_json(fields[S.ATTRIBUTES], OBJECTS), lambda a: ~F.map_contains_key(a, S.RESULT)
    )
    reason = (
        F.when(F.col("read_error").startswith(S.INVALID_UTF8), F.lit("invalid_utf8"))
        .when(F.col("read_error").startswith(S.INVALID_JSON), F.lit(S.INVALID_JSON))
        .when(F.col("read_error").isNotNull(), F.lit("unreadable"))
        .when(F.col("is_empty"), F.lit("no_articles"))
        .when(article.isNull(), F.lit(S.INVALID_JSON))
    )
    if strict:
        reason = (
            reason.when(
                category.isNull() | ~F.map_contains_key(category, S.CATEGORY_LABEL),
                F.lit("category_missing"),
            )
            .when(
                attributes.isNull() & F.map_contains_key(fields, S.ATTRIBUTES),
                F.lit("attributes_invalid"),
            )
            .when(F.exists(attributes, lambda a: a.isNull()), F.lit("attributes_invalid"))
            .when(F.exists(attributes, lacks_options), F.lit("options_missing"))
            .when(no_result & lacks_result, F.lit("result_missing"))
        )
    return split_documents(raw).select(
        "article_key",
        "source_path",
        "source_file",
        "doc_pos",
        "document",
        *_article(lambda name: article[name]),
        reason.alias("reject_reason"),
    )


def explode_attributes(articles: DataFrame, *keep: str) -> DataFrame:
    """One row per attribute: ``keep`` columns and the fields of the attribute, in order."""
    return articles.select(*keep, F.inline("attributes"))


def explode_images(articles: DataFrame, *keep: str) -> DataFrame:
    """One row per image: ``keep`` columns, ``pos`` and ``url``."""
    return articles.select(*keep, F.posexplode("image_urls").alias("pos", "url"))
