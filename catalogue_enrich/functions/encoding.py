"""Base64 data URLs, file names and ledger lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def data_url(content: Column, media_type: str = "image/jpeg") -> Column:
    """``data:<media_type>;base64,<content>`` (needs unchunked base64, see ``session``)."""
    return F.concat(F.lit(f"data:{media_type};base64,"), F.base64(content))


def base_name(path: Column) -> Column:
    """The part of ``path`` after its last slash; backslashes count as slashes."""
    return F.substring_index(posix(path), "/", -1)


def posix(path: Column) -> Column:
    """``path`` with forward slashes only."""
    return F.replace(path, F.lit("\\"), F.lit("/"))


def join_path(*parts: Column) -> Column:
    """Path parts joined with one slash; an absolute part starts anew."""
    joined = parts[0]
    for part in parts[1:]:
        joined = (
            F.when(part.startswith("/"), part)
            .when((joined == "") | joined.endswith("/"), F.concat(joined, part))
            .otherwise(F.concat(joined, F.lit("/"), part))
        )
    return posix(joined)


def ledger_line(product_id: Column, supplier_colour: Column, url: Column) -> Column:
    """Text form ``id,colour,url`` of a ledger row, without escaping."""
    none = F.lit("None")
    return F.concat_ws(",", *(F.coalesce(c, none) for c in (product_id, supplier_colour, url)))
