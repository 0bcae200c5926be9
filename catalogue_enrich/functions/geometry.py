"""Thumbnail geometry: fit into a box, keep the aspect, never upscale."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _closest(exact: Column, error) -> Column:
    """Floor or ceil of ``exact``, whichever has the smaller error; at least 1, ties to floor."""
    low, high = F.floor(exact), F.ceil(exact)
    picked = F.when(low < 1, F.lit(1)).when(error(low) <= error(high), low).otherwise(high)
    return picked.cast("int")


def thumbnail_size(width: Column, height: Column, box: int = 500) -> Column:
    """``struct<width int, height int>`` of the image after fitting it into ``box`` x ``box``."""
    w, h = width.cast("double"), height.cast("double")
    aspect = w / h
    side = F.lit(float(box))
    wide = aspect > 1
    keep = (w <= box) & (h <= box)
    new_width = _closest(side * aspect, lambda n: F.abs(aspect - n / side))
    new_height = _closest(side / aspect, lambda n: F.abs(aspect - side / n))
    return F.struct(
        F.when(keep, width.cast("int"))
        .when(wide, F.lit(box))
        .otherwise(new_width)
        .alias("width"),
        F.when(keep, height.cast("int"))
        .when(wide, new_height)
        .otherwise(F.lit(box))
        .alias("height"),
    )
