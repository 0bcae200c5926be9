"""Prompt text as ``str.format`` and ``repr`` would write it, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from .json_text import bind

# Characters that repr() writes as an escape: control, format, surrogate, private,
# unassigned, and every separator but the plain space.
_NOT_PRINTABLE = r"[\p{C}\p{Z}&&[^ ]]"


def py_str(value: Column) -> Column:
    """``str(value)`` for a string column: null reads ``None``."""
    return F.coalesce(value, F.lit("None"))


def _escape_char(char: Column) -> Column:
    code = F.ascii(char)
    digits = F.lower(F.hex(code))
    escaped = (
        F.when(code < 0x100, F.concat(F.lit(r"\x"), F.lpad(digits, 2, "0")))
        .when(code < 0x10000, F.concat(F.lit(r"\u"), F.lpad(digits, 4, "0")))
        .otherwise(F.concat(F.lit(r"\U"), F.lpad(digits, 8, "0")))
    )
    return F.when(char.rlike(_NOT_PRINTABLE), escaped).otherwise(char)


def _replace(text: Column, search: str, replacement: str) -> Column:
    return F.replace(text, F.lit(search), F.lit(replacement))


def py_repr(value: Column) -> Column:
    """``repr(value)`` for a string column."""
    text = _replace(value, "\\", "\\\\")
    for char, escape in (("\n", r"\n"), ("\r", r"\r"), ("\t", r"\t")):
        text = _replace(text, char, escape)
    double_quoted = F.contains(value, F.lit("'")) & ~F.contains(value, F.lit('"'))

    def printable(t: Column) -> Column:
        chars = F.transform(F.split(t, ""), _escape_char)
        return F.when(t.rlike(_NOT_PRINTABLE), F.array_join(chars, "")).otherwise(t)

    def quoted(t: Column) -> Column:
        return F.when(double_quoted, F.concat(F.lit('"'), t, F.lit('"'))).otherwise(
            F.concat(F.lit("'"), _replace(t, "'", r"\'"), F.lit("'"))
        )

    return F.when(value.isNull(), F.lit("None")).otherwise(
        bind(text, lambda t: bind(printable(t), quoted))
    )


def py_dict(options: Column) -> Column:
    """``repr`` of an ordered dict held as ``array<struct<id, label>>``; null reads ``None``."""
    items = F.transform(
        options, lambda o: F.concat(py_repr(o["id"]), F.lit(": "), py_repr(o["label"]))
    )
    return F.when(options.isNull(), F.lit("None")).otherwise(
        F.concat(F.lit("{"), F.array_join(items, ", "), F.lit("}"))
    )


def render(template: str, fields: Mapping[str, Column]) -> Column:
    """``template.format(**fields)`` for string columns, as one ``concat``.

    The template is split once on the driver, so braces inside a value are never
    read as fields. Unknown, positional and formatted fields are refused.
    """
    parts: list[Column] = []
    for literal, name, spec, conversion in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is None:
            continue
        if name not in fields:
            raise KeyError(f"template names an unknown field: {name!r}")
        if spec or conversion not in (None, "s", "r"):
            raise ValueError(f"format of template field {name!r} is not supported")
        parts.append(py_repr(fields[name]) if conversion == "r" else py_str(fields[name]))
    return F.concat(*parts) if parts else F.lit("")
