"""Requests: prompt per attribute, routing and chat messages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.pyformat import py_dict, render
from ..schema import COLOUR_ATTRIBUTE


@dataclass(frozen=True)
class Prompts:
    """Prompt texts. The templates are ``str.format`` templates with named fields."""

    system_attribute: str = "You pick the value of one product attribute from its images."
    system_colour: str = "You name the colours of a product from its images as hex codes."
    attribute: str = (
        "Attribute {attribute_id}: {attribute_description}. Look at: {attribute_orientation}.\n"
        "Category: {product_category}. Target group: {target_group}.\n"
        "Answer with one id of {possible_options}."
    )
    colour: str = "Name the main colours of this product for {target_group}."


def is_colour(attribute_id: Column) -> Column:
    """The colour attribute has a prompt and an answer contract of its own."""
    return attribute_id.eqNullSafe(COLOUR_ATTRIBUTE)


def prompt(attribute: Column, category: Column, target_group: Column, texts: Prompts) -> Column:
    """User prompt of one attribute: its label describes it, null values read ``None``."""
    options = py_dict(attribute["options"])
    fields = {
        "attribute_id": attribute["attribute_id"],
        "attribute_description": attribute["label"],
        "attribute_orientation": attribute["orientation"],
        "possible_options": options,
        "product_category": category,
        "target_group": target_group,
    }
    return F.when(
        is_colour(attribute["attribute_id"]), render(texts.colour, {"target_group": target_group})
    ).otherwise(render(texts.attribute, fields))


def with_requests(articles: DataFrame, texts: Prompts, when: Column | None = None) -> DataFrame:
    """Add ``requests``: one per attribute, kept nested so that no shuffle brings them back.

    Where ``when`` is not true there are none, so the model is not asked.
    """
    category, target_group = F.col("product_category"), F.col("target_group")
    colour_id, product_id = F.col("colour_id"), F.col("product_id")

    def request(a: Column) -> Column:
        colour = is_colour(a["attribute_id"])
        return F.struct(
            a["pos"].alias("pos"),
            a["attribute_id"].alias("attribute_id"),
            colour.alias("is_colour"),
            F.when(colour, F.lit(texts.system_colour))
            .otherwise(F.lit(texts.system_attribute))
            .alias("system"),
            prompt(a, category, target_group, texts).alias("prompt"),
            a["options"].alias("options"),
            product_id.alias("product_id"),
            category.alias("product_category"),
            F.when(colour, colour_id).alias("supplier_colour"),
        )

    asked = F.col("attributes")
    if when is not None:
        asked = F.when(when, asked).otherwise(F.array())
    return articles.withColumn("requests", F.transform(asked, request))


def user_content(text: Column, image_urls: Column) -> Column:
    """Content parts of a user message: the text first, then the images in order."""
    none = F.lit(None).cast("string")

    def part(kind: str, value: Column, url: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("type"), value.alias("text"), url.alias("image_url")
        )

    return F.concat(
        F.array(part("text", text, none)),
        F.transform(image_urls, lambda u: part("image_url", none, u)),
    )


def content_json(content: Column) -> Column:
    """Content parts as chat API JSON (an image URL is an object of its own)."""

    def part(p: Column) -> Column:
        return F.when(
            p["type"] == "text", F.to_json(F.struct(p["type"].alias("type"), p["text"].alias("text")))
        ).otherwise(
            F.to_json(
                F.struct(
                    p["type"].alias("type"),
                    F.struct(p["image_url"].alias("url")).alias("image_url"),
                )
            )
        )

    return F.concat(F.lit("["), F.array_join(F.transform(content, part), ","), F.lit("]"))


def messages_json(system: Column, text: Column, image_urls: Column) -> Column:
    """The two chat messages of a request as JSON."""
    system_message = F.to_json(F.struct(F.lit("system").alias("role"), system.alias("content")))
    return F.concat(
        F.lit("["),
        system_message,
        F.lit(',{"role":"user","content":'),
        content_json(user_content(text, image_urls)),
        F.lit("}]"),
    )
