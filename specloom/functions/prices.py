"""Prices in mixed currencies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import group_of, number

__all__ = ["price_by_currency", "price_eur", "price_source", "PRICE_PATTERNS", "FX_TO_EUR"]

# Price patterns by currency and euro rates, in order of preference.
PRICE_PATTERNS = {
    "eur": r"(?U)(?:About\s)?€\s*(\d{1,3}(?:,\d{3})*\.?\d*)|(?:About\s)?(\d{1,3}(?:,\d{3})*\.?\d*)\s*EUR",
    "usd": r"(?U)(?:About\s)?\$\s*(\d{1,3}(?:,\d{3})*\.?\d*)",
    "gbp": r"(?U)(?:About\s)?£\s*(\d{1,3}(?:,\d{3})*\.?\d*)",
    "inr": r"(?U)(?:About\s)?₹\s*(\d{1,3}(?:,\d{3})*\.?\d*)|(?:About\s)?(\d{1,3}(?:,\d{3})*\.?\d*)\s*INR",
}
FX_TO_EUR = {"eur": 1.0, "usd": 0.93, "gbp": 1.17, "inr": 0.011}


def _amount(c: Column, currency: str) -> Column:
    pattern = PRICE_PATTERNS[currency]
    groups = [group_of(c, pattern, g) for g in ((1, 2) if currency in ("eur", "inr") else (1,))]
    return number(F.replace(F.coalesce(*groups), F.lit(","), F.lit("")))


def price_by_currency(c: Column) -> Column:
    """Every currency found in the text, as a struct of doubles."""
    return F.struct(*[_amount(c, k).alias(k) for k in PRICE_PATTERNS])


def price_eur(c: Column, rates: dict[str, float] = FX_TO_EUR) -> Column:
    """Native euro first, else the next currency found, converted."""
    return F.coalesce(
        _amount(c, "eur"), *[_amount(c, k) * F.lit(rates[k]) for k in ("usd", "gbp", "inr")]
    )


def price_source(c: Column) -> Column:
    """Which currency the euro price came from."""
    label = F.when(c.isNull(), "missing").when(_amount(c, "eur").isNotNull(), "EUR-native")
    for k in ("usd", "gbp", "inr"):
        label = label.when(_amount(c, k).isNotNull(), f"from {k.upper()}")
    return label.otherwise("unrecognised")
