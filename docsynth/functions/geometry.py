"""Box arithmetic as column expressions.

Coordinate systems: annotation boxes are in template-image pixels with a
top-left origin; form widgets are in PDF points with a bottom-left origin;
label boxes are in rendered-image pixels (optionally scaled) with a top-left
origin again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINTS_PER_INCH = 72.0
DEFAULT_RESOLUTION = 100.0
DEFAULT_RENDER_FACTOR = 2


def page_points(pixels: Column, resolution: float = DEFAULT_RESOLUTION) -> Column:
    """Page size in points of an image written at ``resolution`` dpi."""
    return pixels.cast("double") * F.lit(POINTS_PER_INCH) / F.lit(float(resolution))


def scale_to_page(x1: Column, y1: Column, x2: Column, y2: Column, scale_w: Column, scale_h: Column,
                  axes: str = "swapped") -> tuple[Column, Column, Column, Column]:
    """Scale an annotation box to the page. ``axes='swapped'`` is the
    reference rule (x times the height scale, y times the width scale);
    ``'straight'`` uses the matching scale per axis."""
    sx, sy = (scale_h, scale_w) if axes == "swapped" else (scale_w, scale_h)
    return x1 * sx, y1 * sy, x2 * sx, y2 * sy


def to_bottom_left(x1: Column, y1: Column, x2: Column, y2: Column, height: Column):
    """Top-left box to bottom-left origin: ``[x1, H-y2-1, x2, H-y1-1]``."""
    one = F.lit(1.0)
    return x1, height - y2 - one, x2, height - y1 - one


def to_image_rows(x0: Column, y0: Column, x1: Column, y1: Column, height: Column):
    """Bottom-left box to image rows, widened by one pixel left and right and
    shifted by a tenth of its height (truncated); y0 ends above y1."""
    shift = ((y1 - y0) * F.lit(0.1)).cast("int")
    return x0 - F.lit(1), height - y0 - shift, x1 + F.lit(1), height - y1 - shift


def quad(x0: Column, y0: Column, x1: Column, y1: Column) -> list[Column]:
    """Truncate to int and list the four corners: x1,y1,x2,y1,x2,y2,x1,y2."""
    a, b, c, d = (v.try_cast("int") for v in (x0, y0, x1, y1))  # out of range: null
    return [a, b, c, b, c, d, a, d]
