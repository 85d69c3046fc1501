"""Physical measures: body, battery, display, year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import group_of, let, number, strip

__all__ = [
    "dimensions", "dimensions_state", "weight_g", "battery_mah", "display_size", "resolution",
    "pixel_count", "launch_year", "size_class",
]

# Body-dimension shapes, tried in this order.
THREE_AXES = r"(?iU)(\d+(?:\.\d+)?)\s*x\s*(\d+(?:\.\d+)?)\s*x\s*(\d+(?:\.\d+)?)\s*mm"
UNKNOWN_WIDTH = r"(?iU)(\d+(?:\.\d+)?)\s*x\s*(?:unknown|x\.x|-)\s*x\s*(\d+(?:\.\d+)?)\s*mm"
TWO_AXES = r"(?iU)(\d+(?:\.\d+)?)\s*x\s*(\d+(?:\.\d+)?)\s*mm\b"
THICK = r"(?iU)(\d+(?:\.\d+)?)\s*mm\s*thick"
THICK_LABEL = r"(?iU)thickness[^0-9]*(\d+(?:\.\d+)?)\s*mm"
VOLUME_CC = r"(?iU)(\d+(?:\.\d+)?)\s*cc\b"
# Other measure patterns.
FIRST_NUMBER = r"(?U)(\d+(?:\.\d+)?)"
MAH = r"(?iU)(\d[\d,]*(?:\.\d+)?)\s*mAh"
INCHES = r"(?U)(\d+\.?\d*) inches"
SQUARE_CM = r"(?U)(\d+\.?\d*) cm2"
SCREEN_RATIO = r"(?U)~(\d+\.?\d*)%"
PIXELS = r"(?U)(\d+ x \d+) pixels"
ASPECT = r"(?U)(\d+(?:\.\d+)?:\d+) ratio"
PPI = r"(?U)~?(\d+) ppi"
NO_YEAR = "Not announced yet"
LARGE_FROM_INCH = 7


def _axes(length=None, width=None, height=None, volume=None) -> Column:
    none = F.lit(None).cast("double")
    named = {"length": length, "width": width, "height": height, "volume": volume}
    return F.struct(*[(none if v is None else v).alias(k) for k, v in named.items()])


def _first_shape(c: Column) -> Column:
    a, b, h = (number(group_of(c, THREE_AXES, g)) for g in (1, 2, 3))
    one = lambda p, g=1: number(group_of(c, p, g))
    return (
        F.when(c.rlike(THREE_AXES), _axes(a, b, h, a * b * h))
        .when(c.rlike(UNKNOWN_WIDTH), _axes(length=one(UNKNOWN_WIDTH), height=one(UNKNOWN_WIDTH, 2)))
        .when(c.rlike(TWO_AXES), _axes(length=one(TWO_AXES), width=one(TWO_AXES, 2)))
        .when(c.rlike(THICK), _axes(height=one(THICK)))
        .when(c.rlike(THICK_LABEL), _axes(height=one(THICK_LABEL)))
        .when(c.rlike(VOLUME_CC), _axes(volume=one(VOLUME_CC)))
        .otherwise(_axes())
    )


def dimensions(c: Column) -> Column:
    """Length, width, height, volume from the first shape that fits.

    Bound as one value, so that reading four fields does not run the patterns four times.
    """
    return let(c, _first_shape)


def _blank(c: Column) -> Column:
    return c.isNull() | strip(c).isin("", "-")


def dimensions_state(c: Column) -> Column:
    """A18 input: 'missing', 'unparseable' or 'ok' for a dimension text."""
    parsed = dimensions(c)
    hit = F.coalesce(parsed["length"], parsed["height"], parsed["volume"]).isNotNull()
    return F.when(_blank(c), "missing").when(hit, "ok").otherwise("unparseable")


def weight_g(c: Column) -> Column:
    """First number; the unit is ignored, so '0.5 kg' stays 0.5."""
    return number(group_of(c, FIRST_NUMBER))


def battery_mah(c: Column) -> Column:
    """The number right before mAh, half-even rounded; watt-hours alone give NULL."""
    return F.bround(number(F.replace(group_of(c, MAH), F.lit(","), F.lit(""))), 0).try_cast("int")


def display_size(c: Column) -> Column:
    """Inches, square centimetres, screen-to-body percent."""
    return F.struct(
        number(group_of(c, INCHES)).alias("inch"),
        number(group_of(c, SQUARE_CM)).alias("cm2"),
        number(group_of(c, SCREEN_RATIO)).alias("screen_to_body"),
    )


def resolution(c: Column) -> Column:
    """C09: 'W x H' text, aspect ratio text, pixels per inch."""
    return F.struct(
        group_of(c, PIXELS).alias("pixels"),
        group_of(c, ASPECT).alias("ratio"),
        number(group_of(c, PPI)).alias("ppi"),
    )


def pixel_count(pixels: Column) -> Column:
    """W times H; a missing resolution counts 0 pixels."""
    side = F.split(pixels, " x ")
    return F.coalesce(F.get(side, F.lit(0)).try_cast("long") * F.get(side, F.lit(1)).try_cast("long"), F.lit(0))


def launch_year(c: Column) -> Column:
    """First four digits, unless the launch is not announced."""
    return F.when(c != NO_YEAR, group_of(c, r"(?U)(\d{4})").try_cast("int"))


def size_class(inch: Column) -> Column:
    """7 inches and up is large."""
    return F.when(inch >= LARGE_FROM_INCH, "large").otherwise("small")
