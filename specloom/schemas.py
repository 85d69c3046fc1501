"""Schemas of the raw layer and of the star schema, with the declared constraints."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(text: str) -> T.StructType:
    """'name type!, ...' to StructType; `!` marks NOT NULL."""
    kinds = {"str": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "dbl": T.DoubleType()}
    out = T.StructType()
    for part in text.split(","):
        name, kind = part.split()
        out.add(name, kinds[kind.rstrip("!")], not kind.endswith("!"))
    return out


STAR_SCHEMAS = {
    "Device_Name": _struct("id long!, brand str!, model str!"),
    "Network_Technology": _struct("id long!, technology str!"),
    "Sim": _struct("id long!, sim_count str!, sim_type str!"),
    "Camera": _struct(
        "id long!, main_cameras_num int!, selfie_cameras_num int!,"
        "highest_maincam_res dbl, highest_selfiecam_res dbl"
    ),
    "Display": _struct(
        "id long!, display_size_inch dbl!, display_size_cm dbl, screen_to_body_ratio dbl,"
        "resolution_pixels long!, resolution_ratio str, ppi_density dbl"
    ),
    "OS": _struct("id long!, os_name str!, os_version str"),
    "Platform": _struct(
        "id long!, chipset_manufacturer str!, cpu_core_count int!, internal_storage_gb int!, ram_gb int!"
    ),
    "Device": _struct(
        "id long!, device_key str!, device_name_id long, network_technology_id long, camera_id long,"
        "display_id long, os_id long, platform_id long, sim_id long, year int!, launch_status str,"
        "battery_capacity_mah int, weight dbl, length dbl, width dbl, height dbl, volume dbl,"
        "price_eur dbl, form_factor str!"
    ),
}

UNIQUE_KEYS = {
    "Device_Name": ["brand", "model"],
    "Network_Technology": ["technology"],
    "Sim": ["sim_count", "sim_type"],
    "Camera": ["main_cameras_num", "selfie_cameras_num", "highest_maincam_res", "highest_selfiecam_res"],
    "Display": ["display_size_inch", "resolution_pixels", "resolution_ratio", "ppi_density"],
    "OS": ["os_name", "os_version"],
    "Platform": ["chipset_manufacturer", "cpu_core_count", "internal_storage_gb", "ram_gb"],
    "Device": ["device_key"],
}

# The declared CHECK rules, as SQL conditions by rule name.
CHECK_RULES = {
    "Sim": {"ck_sim_count_valid": "sim_count IN ('single', 'dual', 'triple', 'none')"},
    "Camera": {
        "ck_main_cameras_num_min": "main_cameras_num >= 0",
        "ck_selfie_cameras_num_min": "selfie_cameras_num >= 0",
        "ck_highest_maincam_res_pos": "highest_maincam_res > 0",
        "ck_highest_selfiecam_res_pos": "highest_selfiecam_res > 0",
    },
    "Display": {
        "ck_display_size_inch_pos": "display_size_inch > 0",
        "ck_display_size_cm_pos": "display_size_cm > 0",
        "ck_ppi_density_pos": "ppi_density > 0",
        "ck_screen_to_body_ratio_range": "screen_to_body_ratio >= 0",
    },
    "Platform": {
        "ck_ram_gb_pos": "ram_gb > 0",
        "ck_internal_storage_gb_pos": "internal_storage_gb > 0",
        "ck_cpu_core_count_pos": "cpu_core_count > 0",
    },
    "Device": {
        "ck_price_eur_min": "price_eur >= 0",
        "ck_year_range": "year BETWEEN 1995 AND 2030",
        "ck_battery_capacity_pos": "battery_capacity_mah > 0",
        "ck_weight_pos": "weight > 0",
        "ck_length_pos": "length > 0",
        "ck_width_pos": "width > 0",
        "ck_height_pos": "height > 0",
        "ck_volume_pos": "volume > 0",
        "ck_launch_status_valid": "launch_status IN ('Available', 'Discontinued', 'Rumored', 'Canceled')",
        "ck_form_factor_valid": "form_factor IN ('phone', 'watch', 'tablet', 'band', 'other')",
    },
}

FORM_FACTORS = ("phone", "watch", "tablet", "band", "other")

FOREIGN_KEYS = {
    "device_name_id": "Device_Name",
    "network_technology_id": "Network_Technology",
    "camera_id": "Camera",
    "display_id": "Display",
    "os_id": "OS",
    "platform_id": "Platform",
    "sim_id": "Sim",
}

# Column order of the row signature.
SIGNATURE_COLUMNS = [
    "device_name_id", "network_technology_id", "year", "launch_status", "battery_capacity_mah",
    "camera_id", "display_id", "weight", "length", "width", "height", "volume",
    "os_id", "platform_id", "sim_id", "price_eur", "form_factor",
]

# Raw page columns the cleaner reads.
RAW_INPUT_COLUMNS = [
    "brand", "model", "Network_Technology", "Launch_Announced", "Launch_Status",
    "Body_Dimensions", "Body_Weight", "Body_SIM",
    "Network_2G bands", "Network_3G bands", "Network_4G bands", "Network_5G bands",
    "Battery_Type", "Features_Sensors", "Display_Size", "Display_Resolution",
    "Platform_OS", "Platform_Chipset", "Platform_CPU", "Memory_Card slot", "Memory_Internal",
    "Main Camera_Single", "Main Camera_Dual", "Main Camera_Triple", "Main Camera_Quad",
    "Main Camera_Dual or Triple", "Main Camera_Penta", "Main Camera_Five",
    "Main Camera_Video", "Main Camera_Features",
    "Selfie camera_Single", "Selfie camera_Dual", "Selfie camera_Triple",
    "Selfie camera_Video", "Selfie camera_Features", "Misc_Price",
]

# Raw page columns that the cleaned table no longer carries.
RAW_DROPPED_COLUMNS = [
    "Network_", "Network_Speed", "Display_Type", "Memory_", "Main Camera_Features", "Main Camera_Video",
    "Selfie camera_Video", "Sound_Loudspeaker", "Sound_3.5mm jack", "Comms_WLAN", "Comms_Bluetooth",
    "Comms_Positioning", "Comms_NFC", "Comms_Radio", "Comms_USB", "Misc_Colors",
    "Main Camera_Single", "Main Camera_Dual", "Main Camera_Triple", "Main Camera_Quad",
    "Main Camera_Dual or Triple", "Main Camera_Penta", "Main Camera_Five",
    "Selfie camera_Single", "Selfie camera_Dual", "Selfie camera_Triple",
    "Selfie camera_", "Main Camera", "Selfie camera", "Main Camera_",
    "Display_Size", "Display_Resolution", "Platform_OS", "Platform_Chipset", "Platform_CPU", "Platform_GPU",
    "Memory_Card slot", "Misc_Models", "Misc_Price", "Memory_Internal", "Body_Dimensions", "Body_Weight",
    "Network_2G bands", "Network_3G bands", "Network_4G bands", "Network_5G bands",
    "Battery_Type", "Features_Sensors", "Body_Build", "Selfie camera_Features", "Display_Protection",
    "Battery_Charging", "Display_", "Misc_SAR", "Network_GPRS", "Network_EDGE", "Body_",
    "Comms_Infrared port", "Battery_Stand-by", "Battery_Talk time", "Features_", "Sound_",
    "Battery_Music play", "Platform", "Memory_Phonebook", "Memory_Call records", "Features_Messaging",
    "Features_Games", "Features_Java", "Misc_SAR EU", "Body_Keyboard", "Features_Browser",
    "Sound_Alert types", "Features_Clock", "Features_Alarm", "Features_Languages",
]

# Every raw column is text: types are decided by the cleaning rules, never inferred.
RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in dict.fromkeys(RAW_INPUT_COLUMNS + RAW_DROPPED_COLUMNS)]
)
PRICE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("Model", "Configuration", "Price")])

# Cleaned column name to staged column name.
STAGE_NAMES = {
    "Number of main cameras": "main_cameras_num",
    "Number of selfie cameras": "selfie_cameras_num",
    "Body_SIM": "body_sim",
    "SIM_type": "sim_type",
    "SIM_count": "sim_count",
    "Network_Technology": "network_technology",
    "Launch_Status": "launch_status",
    "Battery_capacity": "battery_capacity_mah",
    "Display_Size_Inch": "display_size_inch",
    "Display_Size_Cm": "display_size_cm",
    "Screen_To_Body_Ratio": "screen_to_body_ratio",
    "Resolution_Pixels": "resolution_pixels",
    "Resolution_Ratio": "resolution_ratio",
    "PPI_Density": "ppi_density",
    "base_os": "os_name",
    "OS_Version": "os_version",
    "Chipset_Manufacturer": "chipset_manufacturer",
    "CPU_Core_Count": "cpu_core_count",
    "Highest_maincam_res": "highest_maincam_res",
    "Highest_selfiecam_res": "highest_selfiecam_res",
    "Price_EUR": "price_eur",
    "Sensors": "sensor_payload",
}

# Columns the staging step cannot do without.
STAGE_REQUIRED = [
    "brand", "model", "body_sim", "sim_type", "sim_count", "network_technology", "launch_status",
    "main_cameras_num", "selfie_cameras_num", "highest_maincam_res", "highest_selfiecam_res",
    "weight", "length", "width", "height", "volume", "battery_capacity_mah",
    "display_size_inch", "display_size_cm", "screen_to_body_ratio", "resolution_pixels",
    "resolution_ratio", "ppi_density", "os_name", "os_version", "chipset_manufacturer",
    "cpu_core_count", "Storage", "RAM", "price_eur", "sensor_payload", "2G", "3G", "4G", "5G", "year",
]


@dataclass(frozen=True)
class Star:
    """The eight tables an analytics plan reads."""

    Device: DataFrame
    Device_Name: DataFrame
    Network_Technology: DataFrame
    Sim: DataFrame
    Camera: DataFrame
    Display: DataFrame
    OS: DataFrame
    Platform: DataFrame

    def register(self) -> None:
        """Expose the tables to SQL under their own names."""
        for f in fields(self):
            getattr(self, f.name).createOrReplaceTempView(f.name)
