"""Product recommendation by typed filters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.filters import all_of, contains, form_filter, in_list
from ..operators.joins import recommend_star
from ..operators.ranking import distinct_sorted, top_n
from ..operators.reshape import project
from ..schemas import FORM_FACTORS, Star

# Sort keys and the output columns.
SORT_COLUMNS = {"price": "price_eur", "battery": "battery_capacity_mah", "ram": "ram_gb", "year": "year"}
OUTPUT = {
    "device_id": "id", "brand": "brand", "model": "model", "year": "year", "form_factor": "form_factor",
    "price_eur": "price_eur", "ram_gb": "ram_gb", "storage_gb": "internal_storage_gb",
    "battery_mah": "battery_capacity_mah", "display_inch": "display_size_inch", "os": "os_name",
    "chipset": "chipset_manufacturer", "network": "technology",
}


@dataclass(frozen=True)
class Request:
    max_price_eur: float | None = None
    brands: list[str] | None = None
    os_name: str | None = None
    min_ram_gb: int | None = None
    min_storage_gb: int | None = None
    min_battery_mah: int | None = None
    min_display_inch: float | None = None
    max_display_inch: float | None = None
    require_5g: bool = False
    form_factor: str = "phone"
    sort_by: str = "price"
    sort_order: str = "asc"
    limit: int = 50

    def __post_init__(self):
        for name in ("max_price_eur", "min_ram_gb", "min_storage_gb", "min_battery_mah",
                     "min_display_inch", "max_display_inch"):
            value = getattr(self, name)
            if value is not None and value < 0:
                raise ValueError(f"{name} must not be negative")
        if not 1 <= self.limit <= 200:
            raise ValueError("limit must lie between 1 and 200")
        if self.sort_by not in SORT_COLUMNS or self.sort_order not in ("asc", "desc"):
            raise ValueError("unknown sort key or order")
        if self.form_factor not in (*FORM_FACTORS, "any"):
            raise ValueError(f"unknown form_factor: {self.form_factor!r}")


def build_filters(r: Request) -> list[Column]:
    """one predicate per field that is set."""
    bounds = [
        (r.max_price_eur, lambda v: F.col("price_eur") <= v),
        (r.brands or None, lambda v: in_list("brand", v)),
        (r.os_name or None, lambda v: F.col("os_name") == v),
        (r.min_ram_gb, lambda v: F.col("ram_gb") >= v),
        (r.min_storage_gb, lambda v: F.col("internal_storage_gb") >= v),
        (r.min_battery_mah, lambda v: F.col("battery_capacity_mah") >= v),
        (r.min_display_inch, lambda v: F.col("display_size_inch") >= v),
        (r.max_display_inch, lambda v: F.col("display_size_inch") <= v),
        (r.require_5g or None, lambda v: contains("technology", "5G")),
        (None if r.form_factor == "any" else r.form_factor, form_filter),
    ]
    return [make(v) for v, make in bounds if v is not None]


def recommend(t: Star, request: Request) -> DataFrame:
    """Filtered star rows by one sort key; ties follow the remaining output columns."""
    rows = project(recommend_star(t).filter(all_of(build_filters(request))), OUTPUT)
    key = {src: out for out, src in OUTPUT.items()}[SORT_COLUMNS[request.sort_by]]
    ties = [F.asc_nulls_last(c) for c in OUTPUT if c != key]
    return top_n(rows, key, request.limit, request.sort_order == "desc", ties)


def list_brands(t: Star) -> DataFrame:
    """T04."""
    return distinct_sorted(t.Device_Name, "brand")


def list_os(t: Star) -> DataFrame:
    """T04."""
    return distinct_sorted(t.OS, "os_name")
