"""The reference question set as DataFrame plans.

Where a question leaves ties open, the remaining output columns settle them, so
that every answer is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import count_where, yearly_avg
from ..operators.filters import contains, form_filter
from ..operators.joins import join_dim
from ..operators.ranking import top_per_period
from ..schemas import Star
from .analytics import best_per_top_brand

_DIMS = {
    "brand": ("Device_Name", "device_name_id"), "model": ("Device_Name", "device_name_id"),
    "ram_gb": ("Platform", "platform_id"), "internal_storage_gb": ("Platform", "platform_id"),
    "chipset_manufacturer": ("Platform", "platform_id"), "technology": ("Network_Technology", "network_technology_id"),
    "highest_maincam_res": ("Camera", "camera_id"), "os_name": ("OS", "os_id"), "sim_count": ("Sim", "sim_id"),
    "display_size_inch": ("Display", "display_id"),
}


def devices_with(t: Star, *cols: str, form_factor: str | None = "phone") -> DataFrame:
    """Devices inner-joined to just the dimensions that hold the named columns."""
    rows = t.Device if form_factor is None else t.Device.filter(form_filter(form_factor))
    wanted: dict[tuple[str, str], list[str]] = {}
    for c in cols:
        wanted.setdefault(_DIMS[c], []).append(c)
    for (table, fk), names in wanted.items():
        rows = join_dim(rows, getattr(t, table), fk, names)
    return rows


def _first(rows: DataFrame, cols: list[str], by: str, n: int, down: bool = False) -> DataFrame:
    order = F.desc(by) if down else F.asc(by)
    ties = [F.asc_nulls_last(c) for c in cols if c != by]
    return rows.select(*cols).orderBy(order, *ties).limit(n)


def _counted(rows: DataFrame, key: str, n: int | None = None) -> DataFrame:
    counts = rows.groupBy(key).agg(F.count("*").alias("device_count"))
    return counts if n is None else counts.orderBy(F.desc("device_count"), F.asc(key)).limit(n)


def _avg_price(rows: DataFrame) -> DataFrame:
    return rows.filter("price_eur IS NOT NULL").groupBy("brand").agg(
        F.count("*").alias("device_count"), F.round(F.avg("price_eur"), 2).alias("avg_price_eur"))


def q01(t: Star, brand="Apple", year=2023) -> DataFrame:
    rows = devices_with(t, "brand", "model").filter((F.col("brand") == brand) & (F.col("year") == year))
    return _first(rows.filter("price_eur IS NOT NULL"), ["brand", "model", "year", "price_eur"], "price_eur", 5)


def q02(t: Star, ram=12) -> DataFrame:
    rows = devices_with(t, "brand", "model", "ram_gb").filter(F.col("ram_gb") >= ram)
    return _first(rows, ["brand", "model", "ram_gb", "price_eur"], "ram_gb", 10, down=True)


def q03(t: Star, price=200) -> DataFrame:
    return count_where(t.Device, form_filter("phone") & (F.col("price_eur") < price))


def q04(t: Star) -> DataFrame:
    rows = devices_with(t, "brand", "model").filter("price_eur IS NOT NULL")
    return _first(rows, ["brand", "model", "price_eur"], "price_eur", 1, down=True)


def q05(t: Star, least=10) -> DataFrame:
    return _avg_price(devices_with(t, "brand")).filter(F.col("device_count") >= least)


def q06(t: Star) -> DataFrame:
    return _first(_avg_price(devices_with(t, "brand")), ["brand", "avg_price_eur"], "avg_price_eur", 5, down=True)


def q07(t: Star) -> DataFrame:
    return _counted(devices_with(t, "brand"), "brand", 10)


def q08(t: Star) -> DataFrame:
    rows = devices_with(t, "chipset_manufacturer").dropna(subset=["battery_capacity_mah", "chipset_manufacturer"])
    return rows.groupBy("chipset_manufacturer").agg(F.round(F.avg("battery_capacity_mah"), 0).alias("avg_battery_mah"))


def q09(t: Star) -> DataFrame:
    return count_where(devices_with(t, "technology"), contains("technology", "5G"))


def q10(t: Star, ram=8) -> DataFrame:
    rows = devices_with(t, "brand", "model", "ram_gb", "technology").filter(contains("technology", "5G"))
    rows = rows.filter((F.col("ram_gb") >= ram) & F.col("price_eur").isNotNull())
    return _first(rows, ["brand", "model", "ram_gb", "price_eur"], "price_eur", 5)


def q11(t: Star, first=2020, last=2024) -> DataFrame:
    rows = t.Device.filter(form_filter("phone") & F.col("year").between(first, last))
    return rows.groupBy("year").agg(F.count("*").alias("launches")).orderBy("year")


def q12(t: Star, since=2018) -> DataFrame:
    return yearly_avg(devices_with(t, "ram_gb"), "ram_gb", since, name="avg_ram_gb")


def q13(t: Star) -> DataFrame:
    return count_where(t.Device, form_filter("phone") & F.col("price_eur").isNull())


def q14(t: Star) -> DataFrame:
    return count_where(t.Device, form_filter("phone") & F.col("platform_id").isNull())


def q15(t: Star) -> DataFrame:
    return best_per_top_brand(t, 5)


def q16(t: Star, brand="Samsung") -> DataFrame:
    cols = ["brand", "model", "chipset_manufacturer", "ram_gb", "highest_maincam_res"]
    return _first(devices_with(t, *cols).filter(F.col("brand") == brand), cols, "model", 10)


def q17(t: Star) -> DataFrame:
    return count_where(t.Device, form_filter("watch"))


def q18(t: Star) -> DataFrame:
    return count_where(t.Device, form_filter("tablet"))


def q19(t: Star) -> DataFrame:
    return _counted(devices_with(t, "os_name"), "os_name", 5)


def q20(t: Star) -> DataFrame:
    rows = devices_with(t, "chipset_manufacturer").filter("chipset_manufacturer IS NOT NULL")
    return _counted(rows, "chipset_manufacturer", 5)


def q21(t: Star, year=2024) -> DataFrame:
    rows = devices_with(t, "display_size_inch").filter(F.col("year") == year)
    return rows.agg(F.round(F.avg("display_size_inch"), 2).alias("avg_inch"))


def q22(t: Star) -> DataFrame:
    return count_where(devices_with(t, "sim_count"), F.col("sim_count") == "dual")


def q23(t: Star, storage=256) -> DataFrame:
    rows = devices_with(t, "brand", "model", "internal_storage_gb").filter(F.col("internal_storage_gb") >= storage)
    return _first(rows.filter("price_eur IS NOT NULL"), ["brand", "model", "internal_storage_gb", "price_eur"], "price_eur", 1)


def q24(t: Star, brand="Apple", ram=8) -> DataFrame:
    rows = devices_with(t, "brand", "model", "ram_gb").filter((F.col("brand") == brand) & (F.col("ram_gb") >= ram))
    return _first(rows, ["brand", "model", "year", "ram_gb"], "year", 100, down=True)


def q25(t: Star, since=2015) -> DataFrame:
    return yearly_avg(t.Device.filter(form_filter("phone")), "price_eur", since, name="avg_price_eur")


def e01(t: Star, since=2023) -> DataFrame:
    rows = devices_with(t, "brand", "model", "ram_gb", "internal_storage_gb", "highest_maincam_res")
    rows = rows.filter(F.col("price_eur").isNotNull() & (F.col("year") >= since))
    cols = ["brand", "model", "year", "price_eur", "ram_gb", F.col("internal_storage_gb").alias("storage_gb"),
            "battery_capacity_mah", "highest_maincam_res"]
    order = [F.desc(c) for c in ("ram_gb", "battery_capacity_mah", "highest_maincam_res")]
    return rows.select(*cols).orderBy(*order, "brand", "model", "year", "price_eur").limit(10)


def e02(t: Star, brand="Apple", price=800, since=2022) -> DataFrame:
    rows = devices_with(t, "brand", "model", "ram_gb", "internal_storage_gb")
    rows = rows.filter((F.col("brand") == brand) & (F.col("price_eur") < price) & (F.col("year") >= since))
    rows = rows.withColumnRenamed("internal_storage_gb", "storage_gb")
    return _first(rows, ["brand", "model", "year", "price_eur", "ram_gb", "storage_gb"], "price_eur", 100)


def e03(t: Star, ram=12) -> DataFrame:
    rows = devices_with(t, "brand", "model", "ram_gb", "technology", form_factor=None).filter(contains("technology", "5G"))
    rows = rows.filter((F.col("ram_gb") >= ram) & F.col("price_eur").isNotNull())
    return _first(rows, ["brand", "model", "year", "ram_gb", "price_eur", "technology"], "price_eur", 100)


def e04(t: Star, least=5) -> DataFrame:
    rows = _avg_price(devices_with(t, "brand", form_factor=None)).filter(F.col("device_count") >= least)
    return _first(rows, ["brand", "device_count", "avg_price_eur"], "avg_price_eur", 100, down=True)


def e05(t: Star, since=2015) -> DataFrame:
    rows = t.Device.filter((F.col("year") >= since) & F.col("battery_capacity_mah").isNotNull())
    return rows.groupBy("year").agg(
        F.count("*").alias("device_count"), F.round(F.avg("battery_capacity_mah"), 0).alias("avg_battery_mah")
    ).orderBy("year").limit(100)


def e06(t: Star) -> DataFrame:
    rows = devices_with(t, "chipset_manufacturer", form_factor=None).filter("chipset_manufacturer IS NOT NULL")
    return top_per_period(rows, "year", "chipset_manufacturer").orderBy("year").limit(100)


def e07(t: Star, brand="Nokia") -> DataFrame:
    rows = devices_with(t, "brand", "model").filter(F.col("brand") == brand)
    return rows.select("brand", "model", "year", "price_eur").orderBy(
        F.desc("year"), "model", F.asc_nulls_last("price_eur")).limit(5000)
