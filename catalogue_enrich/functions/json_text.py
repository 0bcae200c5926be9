"""JSON text, built and edited without losing keys, nulls or key order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# How documents are read: values as text, or as variants that know their types.
OBJECT = "map<string,string>"
OBJECTS = "array<map<string,string>>"
TYPED_OBJECT = "map<string,variant>"
TYPED_OBJECTS = "array<map<string,variant>>"


# JSON and nothing looser, as elsewhere text is parsed into variants.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def read_json(text: Column, schema: str | DataType) -> Column:
    """``text`` read as ``schema``; null if it is not JSON."""
    return F.from_json(text, schema, _STRICT)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also inside a lambda function."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# What a JSON string must escape.
_ESCAPED = r'["\\\x00-\x1f]'
# How the text of a value that is not a string may start.
_NOT_A_STRING = r"^(?:[\[{0-9-]|true$|false$)"


def json_string(text: Column) -> Column:
    """``text`` as a JSON string literal; null reads ``null``."""
    literal = F.to_json(F.array(text))
    return (
        F.when(text.isNull(), F.lit("null"))
        .when(text.rlike(_ESCAPED), F.substring(literal, F.lit(2), F.length(literal) - 2))
        .otherwise(F.concat(F.lit('"'), text, F.lit('"')))
    )


def json_value(text: Column, value: Column) -> Column:
    """JSON text of one value: ``text`` as it was read, quoted again if it was a string."""
    is_string = ~text.rlike(_NOT_A_STRING) | (F.schema_of_variant(value) == "STRING")
    return (
        F.when(text.isNull(), F.lit("null")).when(is_string, json_string(text)).otherwise(text)
    )


def members(strings: Column, variants: Column) -> Column:
    """An object read as text and as variants, as an ordered map of key to JSON text.

    Of duplicate keys the last gives the value and the first the place.
    """
    return F.map_from_entries(
        F.zip_with(
            F.map_entries(strings),
            F.map_entries(variants),
            lambda s, v: F.struct(
                s["key"].alias("key"), json_value(s["value"], v["value"]).alias("value")
            ),
        )
    )


def object_text(items: Column) -> Column:
    """JSON text of an object from its ``members``."""
    parts = F.transform(
        F.map_entries(items), lambda m: F.concat(json_string(m["key"]), F.lit(":"), m["value"])
    )
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))


def put(items: Column, key: str, json: Column) -> Column:
    """``members`` with ``key`` set in place, or appended."""
    return F.map_concat(items, F.create_map(F.lit(key), json))


def starts_with(text: Column, bracket: str) -> Column:
    """The first character of ``text`` after JSON white space is ``bracket``."""
    return F.ltrim(text, F.lit(" \t\n\r")).startswith(bracket)
