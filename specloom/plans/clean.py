"""The cleaning chain from raw page fields to priced configurations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import audit
from ..operators.audit import Audit
from ..operators.impute import impute_cascade
from ..operators.reshape import conform, drop_required, expand_configs, override_price
from ..schemas import RAW_DROPPED_COLUMNS, RAW_SCHEMA

# How many cameras each raw column stands for, in column order.
MAIN_CAMERAS = {
    "Main Camera_Single": 1, "Main Camera_Dual": 2, "Main Camera_Triple": 3, "Main Camera_Quad": 4,
    "Main Camera_Dual or Triple": 3, "Main Camera_Penta": 5, "Main Camera_Five": 5,
}
SELFIE_CAMERAS = {"Selfie camera_Single": 1, "Selfie camera_Dual": 2, "Selfie camera_Triple": 3}
# Products up to this year are left out.
AFTER_YEAR = 2010

# Which raw columns each audited column comes from.
AUDITED = {
    "Number of main cameras": list(MAIN_CAMERAS), "Number of selfie cameras": list(SELFIE_CAMERAS),
    "Highest_maincam_res": list(MAIN_CAMERAS), "Highest_selfiecam_res": list(SELFIE_CAMERAS),
    "length": ["Body_Dimensions"], "width": ["Body_Dimensions"], "height": ["Body_Dimensions"],
    "volume": ["Body_Dimensions"], "weight": ["Body_Weight"], "Battery_capacity": ["Battery_Type"],
    "SIM_type": ["Body_SIM"], "SIM_count": ["Body_SIM"],
    "Display_Size_Inch": ["Display_Size"], "Display_Size_Cm": ["Display_Size"],
    "Screen_To_Body_Ratio": ["Display_Size"],
    "Resolution_Pixels": ["Display_Resolution"], "Resolution_Ratio": ["Display_Resolution"],
    "PPI_Density": ["Display_Resolution"],
    "base_os": ["Platform_OS"], "OS_Version": ["Platform_OS"],
    "Chipset_Manufacturer": ["Platform_Chipset"], "CPU_Core_Count": ["Platform_CPU"], "Sensors": ["Features_Sensors"],
}
FLAGS = ["2G", "3G", "4G", "5G"]


def _raw(name: str) -> Column:
    return F.col(f"`{name}`")


def cleaned_columns() -> dict[str, Column]:
    """Every row-preserving rule, by the name of the column it makes."""
    size = fn.display_size(_raw("Display_Size"))
    res = fn.resolution(_raw("Display_Resolution"))
    body = fn.dimensions(_raw("Body_Dimensions"))
    return {
        "Number of main cameras": fn.count_from_populated(MAIN_CAMERAS),
        "Number of selfie cameras": fn.count_from_populated(SELFIE_CAMERAS),
        "Highest_maincam_res": fn.highest_mp(fn.first_non_null(*map(_raw, MAIN_CAMERAS))),
        "Highest_selfiecam_res": fn.highest_mp(fn.first_non_null(*map(_raw, SELFIE_CAMERAS))),
        "weight": fn.weight_g(_raw("Body_Weight")),
        **{axis: body[axis] for axis in ("length", "width", "height", "volume")},
        **{g: fn.network_flag(_raw(f"Network_{g} bands")) for g in ("2G", "3G", "4G", "5G")},
        "Battery_capacity": fn.battery_mah(_raw("Battery_Type")),
        "Sensors": fn.split_list(_raw("Features_Sensors")),
        "SIM_type": fn.sim_type(_raw("Body_SIM")),
        "SIM_count": fn.sim_count(_raw("Body_SIM")),
        "Display_Size_Inch": size["inch"],
        "Display_Size_Cm": size["cm2"],
        "Screen_To_Body_Ratio": size["screen_to_body"],
        "Resolution_Pixels": res["pixels"],
        "Resolution_Ratio": res["ratio"],
        "PPI_Density": res["ppi"],
        "base_os": fn.base_os(_raw("Platform_OS")),
        "OS_Version": fn.os_version(_raw("Platform_OS")),
        "Chipset_Manufacturer": fn.chipset_maker(_raw("Platform_Chipset")),
        "CPU_Core_Count": fn.cpu_cores(_raw("Platform_CPU")),
        "Card_Slot_Type": fn.card_slot(_raw("Memory_Card slot")),
        "Main_Video": fn.video_res(_raw("Main Camera_Video")),
        "Selfie_Video": fn.video_res(_raw("Selfie camera_Video")),
        "Main_Features": fn.split_list(_raw("Main Camera_Features")),
        "Selfie_Features": fn.split_list(_raw("Selfie camera_Features")),
    }


def audit_frame(raw: DataFrame) -> DataFrame:
    """Raw and cleaned columns side by side. No rule can throw, so none spoils another."""
    return conform(raw, RAW_SCHEMA).withColumns(cleaned_columns())


def audit_all(raw: DataFrame, top: int = 20) -> Audit:
    """L11 over every audited column: counts, most frequent lost texts, and how the network flags are spread."""
    return audit.audit_all(audit_frame(raw), AUDITED, FLAGS, top)


def clean(raw: DataFrame, prices: DataFrame | None = None, impute: bool = True, price_order: str = "seq") -> DataFrame:
    """The whole chain. Of several listed prices the last by the column `price_order` counts. Expansion comes before pricing, brand spelling before imputation.

    The year filter is applied first: it reads one raw column, so dropped products
    cost no further rule.
    """
    year = fn.launch_year(F.col("Launch_Announced"))
    kept = conform(raw, RAW_SCHEMA).withColumn("year", year).filter(F.col("year") > AFTER_YEAR)
    rows = expand_configs(kept, "Memory_Internal").withColumns(cleaned_columns())
    if prices is not None:
        rows = override_price(rows, prices, ordinal=price_order)
    rows = rows.withColumn("Price_EUR", fn.price_eur(F.col("Misc_Price")))
    rows = drop_required(rows, RAW_DROPPED_COLUMNS)
    rows = rows.withColumns({
        "Launch_Status": fn.launch_status(F.col("Launch_Status")),
        "Resolution_Pixels": fn.pixel_count(F.col("Resolution_Pixels")),
        "brand": fn.canonical(F.col("brand"), fn.BRAND_SPELLING),
    }).drop("Main_Video", "Selfie_Video", "Main_Features", "Selfie_Features")
    return impute_cascade(rows) if impute else rows
