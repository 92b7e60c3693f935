"""Image checks on metadata: validity, colour conversion, target size."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Smallest side, largest side after resizing, accepted modes.
MIN_SIDE = 32
MAX_SIDE = 512
ACCEPTED_MODES = ("RGB", "RGBA", "L")


def mode_name(cv_mode: Column) -> Column:
    """Mode name for the type code of Spark's image source (0, 16, 24)."""
    return F.when(cv_mode == 0, "L").when(cv_mode == 16, "RGB").when(cv_mode == 24, "RGBA")


def is_valid(width: Column, height: Column, mode: Column) -> Column:
    """Large enough and in an accepted mode; unreadable images (size -1) are not."""
    ok = (width >= MIN_SIDE) & (height >= MIN_SIDE) & mode.isin(list(ACCEPTED_MODES))
    return F.coalesce(ok, F.lit(False))


def needs_rgb(mode: Column) -> Column:
    """True when the image has to be converted to RGB first."""
    return mode != "RGB"


def target_size(width: Column, height: Column, max_side: int = MAX_SIDE) -> Column:
    """Size after fitting the longer side to `max_side`, with integer truncation.

    Very long images can reach a zero side; `is_degenerate` tells them.
    """
    fits = F.greatest(width, height) <= max_side
    wide = width > height
    short_w = F.floor(width.cast("bigint") * max_side / height)
    short_h = F.floor(height.cast("bigint") * max_side / width)
    return F.struct(
        F.when(fits, width).when(wide, F.lit(max_side)).otherwise(short_w).cast("int").alias("width"),
        F.when(fits, height).when(wide, short_h).otherwise(F.lit(max_side)).cast("int").alias("height"),
    )


def is_degenerate(size: Column) -> Column:
    return (size["width"] < 1) | (size["height"] < 1)
