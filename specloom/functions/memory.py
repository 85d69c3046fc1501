"""Storage and RAM texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import group_of, number, strip

__all__ = ["storage_and_ram", "memory_gb", "storage_tiers", "card_slot"]

# Shapes of one memory configuration, tried in this order, with the
# group numbers of storage and RAM. A multi-storage shape without a single storage
# group is left out: the first shape matches every text that one could match.
CONFIG_SHAPES = [
    (
        r"(?U)(\d+\.?\d*\s*[GTMB]B)(?:\s*\(\d+\.?\d*\s*[GTMB]B\s*user available\))?"
        r"(?:/\s*\d+\.?\d*\s*[GTMB]B\s*\([^)]+\))?,?\s*(\d+\.?\d*\s*[GTMB]B)\s*RAM", 1, 2,
    ),
    (
        r"(?U)(\d+\.?\d*\s*[GTMB]B)\s*\((\d+\.?\d*\s*[GTMB]B)\s*user available\),?\s*"
        r"(\d+\.?\d*\s*[GTMB]B|\d+\.?\d*\s*[GM]B)\s*RAM", 2, 3,
    ),
    (r"(?U)(\d+\.?\d*\s*[GM]B)\s*RAM,\s*(\d+\.?\d*\s*[GM]B)\s*ROM", 2, 1),
    (
        r"(?U)(\d+\.?\d*\s*[GTMB]B)(?:/\s*\d+\.?\d*\s*[GTMB]B)?(?:\s*\([^)]+\))?,\s*"
        r"(\d+\.?\d*\s*[GTMB]B|\d+\.?\d*\s*[GM]B)\s*RAM", 1, 2,
    ),
    (
        r"(?U)(\d+\.?\d*\s*[GTMB]B)/(?:\d+\.?\d*\s*[GTMB]B)(?:\s*\([^)]*\))?,\s*"
        r"(\d+\.?\d*\s*[GTMB]B|\d+\.?\d*\s*[GM]B)\s*RAM", 1, 2,
    ),
    (r"(?U)(\d+\.?\d*\s*[GTMB]B)\s*ROM,\s*(\d+\.?\d*\s*[GTMB]B)\s*RAM", 1, 2),
]
STORAGE_ONLY = r"(?U)^(\d+\.?\d*\s*[GTMB]B)$"
RAM_ONLY = r"(?U)^(\d+\.?\d*\s*[GM]B)\s*RAM$"
CAPACITY = r"(?iU)(\d+(?:\.\d+)?)\s*(TB|GB|MB)\b"
TIER_TOKEN = r"(?iU)\b\d+\s*(?:GB|TB|MB)\s*(?:RAM\b)?"
# Card names in the order they are looked for.
CARD_WORDS = ("microsd", "sd", "mmc", "minisd", "nanomemory")


def storage_and_ram(c: Column) -> Column:
    """C20: storage and RAM text of one configuration piece."""
    none = F.lit(None).cast("string")
    pair = lambda s, r: F.struct(s.alias("storage"), r.alias("ram"))
    shapes = [
        F.when(c.rlike(p), pair(group_of(c, p, s), group_of(c, p, r))) for p, s, r in CONFIG_SHAPES
    ]
    lone = [
        F.when(c.rlike(STORAGE_ONLY), pair(group_of(c, STORAGE_ONLY), none)),
        F.when(c.rlike(RAM_ONLY), pair(none, group_of(c, RAM_ONLY))),
    ]
    return F.coalesce(*shapes, *lone, pair(none, none))


def memory_gb(c: Column) -> Column:
    """Capacity text to whole gigabytes, at least 1 for any positive amount."""
    text = c.cast("string")
    amount = number(group_of(text, CAPACITY, 1))
    unit = F.upper(group_of(text, CAPACITY, 2))
    gb = F.when(unit == "TB", amount * 1024).when(unit == "GB", amount).when(unit == "MB", amount / 1024)
    return F.when(gb <= 0, None).when(gb < 1, 1).otherwise(F.bround(gb, 0).try_cast("int"))


def storage_tiers(c: Column) -> Column:
    """Number of comma fragments that hold a capacity."""
    hits = F.size(F.filter(F.split(c, ","), lambda p: strip(p).rlike(TIER_TOKEN)))
    return F.when(c.isNull(), 0).otherwise(hits)


def card_slot(c: Column) -> Column:
    """Kind of card slot. Any text with 'no' in it counts as No, 'nano...' too."""
    text = F.lower(c)
    label = F.when(c.isNull(), None).when(text.contains("no"), "No")
    for word in CARD_WORDS:
        label = label.when(text.contains(word), word.capitalize())
    return label.when(text.contains("yes"), "Yes").otherwise("Unknown")
