"""The product catalogue seen through the given tables.

Each derived table is one SELECT in SQL that Spark and DuckDB both read, so that
operators and checks start from the same rows. NULLs and missing keys come from
CASE rules, since the given tables have none.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..schemas import RAW_INPUT_COLUMNS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


STAR_SQL = {
    "Device_Name": "SELECT CAST(p_partkey AS BIGINT) AS id, p_brand AS brand, p_name AS model FROM part",
    "Network_Technology": """
        SELECT CAST(n_nationkey AS BIGINT) AS id,
               CASE n_nationkey % 5 WHEN 0 THEN 'GSM / HSPA / LTE / 5G' WHEN 1 THEN 'GSM / HSPA / LTE'
                    WHEN 2 THEN 'CDMA / EVDO' WHEN 3 THEN 'GSM' ELSE 'No cellular connectivity' END AS technology
        FROM nation""",
    "Sim": """
        SELECT CAST(n_nationkey AS BIGINT) AS id,
               CASE n_nationkey % 4 WHEN 0 THEN 'single' WHEN 1 THEN 'dual' WHEN 2 THEN 'triple'
                    ELSE 'none' END AS sim_count,
               CASE n_regionkey WHEN 0 THEN 'nano' WHEN 1 THEN 'micro' WHEN 2 THEN 'mini' WHEN 3 THEN 'esim'
                    ELSE 'none' END AS sim_type
        FROM nation""",
    "Camera": """
        SELECT CAST(p_partkey AS BIGINT) AS id, CAST(1 + p_partkey % 5 AS INT) AS main_cameras_num,
               CAST(p_partkey % 3 AS INT) AS selfie_cameras_num,
               CASE WHEN p_partkey % 21 = 0 THEN NULL ELSE 2.0e0 + p_size * 2 END AS highest_maincam_res,
               CASE WHEN p_partkey % 22 = 0 THEN NULL ELSE 1.3e0 + p_size END AS highest_selfiecam_res
        FROM part""",
    "Display": """
        SELECT CAST(p_partkey AS BIGINT) AS id, 3.0e0 + p_size * 0.1e0 AS display_size_inch,
               50.0e0 + p_size * 1.5e0 AS display_size_cm,
               CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE 60.0e0 + p_partkey % 37 END AS screen_to_body_ratio,
               CAST((480 + p_partkey % 960) * (800 + p_size * 20) AS BIGINT) AS resolution_pixels,
               CASE p_partkey % 3 WHEN 0 THEN '20:9' WHEN 1 THEN '19.5:9' ELSE '16:9' END AS resolution_ratio,
               CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(200 + p_partkey % 317 AS DOUBLE) END AS ppi_density
        FROM part""",
    "OS": f"""
        SELECT CAST(s_suppkey AS BIGINT) AS id,
               CASE s_nationkey % 5 WHEN 0 THEN 'iOS' WHEN 1 THEN 'HarmonyOS' WHEN 2 THEN 'Wear OS'
                    ELSE 'Android' END AS os_name,
               CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE {text("8 + s_suppkey % 7")} END AS os_version
        FROM supplier""",
    "Platform": """
        SELECT CAST(p_partkey AS BIGINT) AS id,
               CASE p_type WHEN 'STANDARD' THEN 'Qualcomm' WHEN 'PROMO' THEN 'Mediatek' WHEN 'LARGE' THEN 'Apple'
                    WHEN 'MEDIUM' THEN 'Samsung' WHEN 'SMALL' THEN 'Exynos' ELSE 'Other' END AS chipset_manufacturer,
               CAST(2 + 2 * (p_partkey % 4) AS INT) AS cpu_core_count,
               CAST(CASE p_partkey % 4 WHEN 0 THEN 64 WHEN 1 THEN 128 WHEN 2 THEN 256 ELSE 512 END AS INT)
                    AS internal_storage_gb,
               CAST(1 + p_size % 16 AS INT) AS ram_gb
        FROM part""",
    "Device": f"""
        SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS id,
               {text("l_orderkey")} || '-' || {text("l_linenumber")} AS device_key,
               CAST(l_partkey AS BIGINT) AS device_name_id,
               CASE WHEN l_partkey % 25 = 24 THEN NULL ELSE CAST(l_partkey % 25 AS BIGINT) END
                    AS network_technology_id,
               CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE CAST(l_partkey AS BIGINT) END AS camera_id,
               CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE CAST(l_partkey AS BIGINT) END AS display_id,
               CASE WHEN l_suppkey % 29 = 0 THEN NULL ELSE CAST(l_suppkey AS BIGINT) END AS os_id,
               CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE CAST(l_partkey AS BIGINT) END AS platform_id,
               CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE CAST(l_suppkey % 25 AS BIGINT) END AS sim_id,
               CAST(year(l_shipdate) + 23 AS INT) AS year,
               CASE WHEN l_linestatus = 'O' THEN 'Available' WHEN l_linenumber = 3 THEN NULL
                    ELSE 'Discontinued' END AS launch_status,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity * 100 AS INT) END AS battery_capacity_mah,
               CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE 120.0e0 + l_quantity + l_partkey % 10 END AS weight,
               140.0e0 + l_suppkey % 30 AS length, 60.0e0 + l_partkey % 20 AS width,
               6.0e0 + l_discount * 20 AS height,
               CASE WHEN l_linenumber = 2 THEN NULL ELSE 50.0e0 + l_quantity * 2 + l_suppkey % 7 END AS volume,
               CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_extendedprice / 100 END AS price_eur,
               CASE l_returnflag WHEN 'A' THEN 'phone' WHEN 'N' THEN 'watch' ELSE 'tablet' END AS form_factor
        FROM lineitem""",
}

_k, _s = "p_partkey", text("p_size")
# One raw page per part; U+2009 stands between some symbols and digits, as on real pages.
RAW_SQL = f"""
    SELECT p_partkey AS part_id,
      CASE WHEN {_k} % 31 = 0 THEN 'alcatel' ELSE p_brand END AS brand,
      p_name || CASE {_k} % 9 WHEN 0 THEN ' Watch' WHEN 1 THEN ' Tab A' WHEN 2 THEN ' Band' WHEN 3 THEN ' iPad'
                     WHEN 4 THEN ' Gear S' ELSE '' END || ' ' || {text(f"{_k} % 50")} AS model,
      CASE {_k} % 4 WHEN 0 THEN 'GSM / HSPA / LTE / 5G' WHEN 1 THEN 'GSM / LTE' WHEN 2 THEN 'CDMA2000'
           ELSE NULL END AS network_technology,
      CASE WHEN {_k} % 20 = 0 THEN 'Not announced yet' WHEN {_k} % 21 = 0 THEN NULL
           WHEN {_k} % 22 = 0 THEN 'Q3' ELSE {text(f"2005 + {_k} % 20")} || ', September 12' END AS launch_announced,
      CASE {_k} % 7 WHEN 0 THEN 'Available. Released 2023, September' WHEN 1 THEN ' discontinued'
           WHEN 2 THEN 'Cancelled' WHEN 3 THEN 'Coming soon. Exp. release 2024' WHEN 4 THEN 'Rumored'
           WHEN 5 THEN 'garbage' ELSE NULL END AS launch_status,
      CASE {_k} % 10 WHEN 0 THEN NULL WHEN 1 THEN 'Foldable' WHEN 2 THEN ' - '
           WHEN 3 THEN {text("100 + p_size")} || ' x ' || {text("50 + p_size")} || ' mm'
           WHEN 4 THEN {text("100 + p_size")} || '.8 x Unknown x 8 mm'
           WHEN 5 THEN {_s} || '.5 mm thickness' WHEN 6 THEN 'Folded thickness: ' || {_s} || ' mm'
           WHEN 7 THEN {_s} || ' cc'
           ELSE {text("100 + p_size")} || '.6 x ' || {text(f"50 + {_k} % 30")} || '.1 x '
                || {text(f"6 + {_k} % 5")} || '.8 MM (5.81 x 2.82 x 0.31 in)' END AS body_dimensions,
      CASE {_k} % 5 WHEN 0 THEN NULL WHEN 1 THEN '0.5 kg' WHEN 2 THEN '-'
           ELSE {text("150 + p_size")} || '.25 g (6.03 oz)' END AS body_weight,
      CASE {_k} % 11 WHEN 0 THEN 'Nano-SIM and eSIM or Dual eSIM' WHEN 1 THEN 'Single SIM (Nano-SIM)'
           WHEN 2 THEN 'Triple SIM (Micro-SIM)' WHEN 3 THEN 'Mini-SIM' WHEN 4 THEN 'eSIM' WHEN 5 THEN ' No '
           WHEN 6 THEN '-' WHEN 7 THEN 'Yes' WHEN 8 THEN NULL WHEN 9 THEN 'Removable card'
           ELSE 'Dual SIM (Nano-SIM, dual stand-by)' END AS body_sim,
      CASE WHEN {_k} % 3 = 0 THEN NULL ELSE 'GSM 850 / 900' END AS network_2g_bands,
      CASE WHEN {_k} % 4 = 0 THEN NULL ELSE 'HSDPA 850' END AS network_3g_bands,
      CASE WHEN {_k} % 5 = 0 THEN NULL ELSE 'LTE 1, 2, 3' END AS network_4g_bands,
      CASE WHEN {_k} % 6 = 0 THEN '1, 3, 5 SA/NSA' ELSE NULL END AS network_5g_bands,
      CASE {_k} % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Li-Po (28.93 Wh)'
           WHEN 2 THEN 'Li-Po 10,' || {text("100 + p_size")} || ' mAh, non-removable'
           WHEN 3 THEN 'Li-Ion ' || {_s} || '.5 mAh (1.19 Wh)' WHEN 4 THEN 'Removable battery'
           ELSE 'Li-Ion ' || {text("1000 + p_size * 50")} || ' MAH, fast charging 33W' END AS battery_type,
      CASE {_k} % 5 WHEN 0 THEN NULL WHEN 1 THEN '[''Face ID'', ''gyro'', ''GYRO'', ''barometer, dual'']'
           WHEN 2 THEN ' Fingerprint (side-mounted), accelerometer,  Compass , compass' WHEN 3 THEN '  '
           ELSE '[accelerometer, "gyro",]' END AS features_sensors,
      CASE {_k} % 4 WHEN 0 THEN NULL WHEN 1 THEN {text(f"4 + {_k} % 4")} || '.67 inches, 107.4 cm2 (~85.0%)'
           WHEN 2 THEN {text(f"5 + {_k} % 3")} || ' inches'
           ELSE '6.1 inches, ' || {text("60 + p_size")} || '.2 cm2 (~'
                || {text("50 + p_size % 50")} || '.4% screen-to-body ratio)' END AS display_size,
      CASE {_k} % 4 WHEN 0 THEN NULL WHEN 1 THEN '1080 x 2400 pixels, 20:9 ratio'
           WHEN 2 THEN {text("480 + p_size")} || ' x 800 pixels (~' || {text("200 + p_size")} || ' ppi density)'
           ELSE {text("700 + p_size")} || ' x 1560 pixels, 19.5:9 ratio (~282 ppi density)' END AS display_resolution,
      CASE {_k} % 13 WHEN 0 THEN NULL WHEN 1 THEN 'iOS 17, upgradable to iOS 17.4' WHEN 2 THEN 'Android, Realme UI 3.0'
           WHEN 3 THEN 'Harmony OS 4.0' WHEN 4 THEN 'Symbian^3, Anna' WHEN 5 THEN 'Wear OS' WHEN 6 THEN 'Blue OS 3.0'
           WHEN 7 THEN 'Firefox 2.0, upgradable to 2.1' WHEN 8 THEN 'Android-based, OMS 2.5'
           WHEN 9 THEN 'Firefox OS, 1.3' WHEN 10 THEN ' Proprietary'
           ELSE 'Android ' || {text(f"8 + {_k} % 7")} || ', One UI 6.1' END AS platform_os,
      CASE {_k} % 8 WHEN 0 THEN NULL WHEN 1 THEN 'Apple A16 Bionic (4 nm)' WHEN 2 THEN 'Samsung Exynos 2400'
           WHEN 3 THEN 'Mediatek Dimensity 7050' WHEN 4 THEN 'Exynos 990' WHEN 5 THEN 'Intel Atom Z2560'
           WHEN 6 THEN 'qualcomm lower' ELSE 'Qualcomm SM8650-AC Snapdragon 8 Gen 3' END AS platform_chipset,
      CASE {_k} % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Single-core' WHEN 3 THEN 'dual-core 2.0 GHz'
           WHEN 4 THEN 'Quad-core 1.4 GHz' WHEN 5 THEN 'Hexa-core (2x3.46 GHz)' WHEN 6 THEN 'Deca-core 2.0 GHz'
           ELSE 'Octa-core (1x3.39 GHz Cortex-X4)' END AS platform_cpu,
      CASE {_k} % 8 WHEN 0 THEN NULL WHEN 1 THEN 'No' WHEN 2 THEN 'microSDXC (dedicated slot)' WHEN 3 THEN 'MMC'
           WHEN 4 THEN 'Yes' WHEN 5 THEN 'NM (nanoMemory)' WHEN 6 THEN 'SD, up to 2GB' ELSE 'slot' END
           AS memory_card_slot,
      CASE {_k} % 7 WHEN 0 THEN NULL WHEN 1 THEN '128GB 6GB RAM, 256GB 8GB RAM'
           WHEN 2 THEN {text("1 + p_size")} || 'GB ' || {text("1 + p_size % 12")} || 'GB RAM; 1TB 12GB RAM'
           WHEN 3 THEN '64GB' WHEN 4 THEN '4GB 512MB RAM, 512MB RAM'
           WHEN 5 THEN '128GB (122GB user available) 6GB RAM, 256GB 6GB RAM (Africa)'
           ELSE '64GB/128GB 4GB RAM' END AS memory_internal,
      CASE WHEN {_k} % 5 = 0 THEN '13 MP, f/2.2' WHEN {_k} % 5 = 4 THEN 'VGA, 0.5m' ELSE NULL END AS main_camera_single,
      CASE WHEN {_k} % 5 = 1 THEN '12 MP + 50.5 MP, OIS' ELSE NULL END AS main_camera_dual,
      CASE WHEN {_k} % 5 = 2 THEN {text("10 + p_size")} || ' MP wide + 12 MP UW' ELSE NULL END AS main_camera_triple,
      CASE WHEN {_k} % 17 = 0 THEN '108 MP + 8 MP + 2 MP + 2 MP' ELSE NULL END AS main_camera_quad,
      CASE WHEN {_k} % 18 = 0 THEN 'Yes' ELSE NULL END AS main_camera_dual_or_triple,
      CAST(NULL AS STRING) AS main_camera_penta,
      CASE WHEN {_k} % 19 = 0 THEN '64 MP x5' ELSE NULL END AS main_camera_five,
      CASE {_k} % 3 WHEN 0 THEN NULL WHEN 1 THEN '4K@60fps, HDR' ELSE '1080p ' END AS main_camera_video,
      CASE {_k} % 3 WHEN 0 THEN NULL WHEN 1 THEN 'LED flash, HDR' ELSE 'LED flash' END AS main_camera_features,
      CASE WHEN {_k} % 4 = 0 THEN NULL ELSE '12 MP, f/1.9' END AS selfie_camera_single,
      CASE WHEN {_k} % 10 = 0 THEN '8 MP + 2 MP' ELSE NULL END AS selfie_camera_dual,
      CAST(NULL AS STRING) AS selfie_camera_triple,
      CASE {_k} % 3 WHEN 0 THEN '4K @30fps' ELSE NULL END AS selfie_camera_video,
      CAST(NULL AS STRING) AS selfie_camera_features,
      CASE {_k} % 10 WHEN 0 THEN NULL WHEN 1 THEN 'About ' || {text("100 + p_size")} || ' EUR'
           WHEN 2 THEN '$ ' || {text("100 + p_size")} || '.99 / £ ' || {text("90 + p_size")} || '.00'
           WHEN 3 THEN '₹ 12,' || {text("400 + p_size")} WHEN 4 THEN '£ ' || {text("500 + p_size")} || '.50'
           WHEN 5 THEN '1234.56' WHEN 6 THEN '€ 1,' || {text("100 + p_size")} || '.50 / $ 899'
           WHEN 7 THEN 'C$ 799.99' WHEN 8 THEN NULL ELSE '74,999 INR' END AS misc_price
    FROM part"""

# Listed prices for some (model, configuration) pairs, several per pair: the last wins.
PRICES_SQL = f"""
    SELECT p_partkey AS seq, model, configuration, price FROM (
      SELECT p_partkey,
        p_name || CASE {_k} % 9 WHEN 0 THEN ' Watch' WHEN 1 THEN ' Tab A' WHEN 2 THEN ' Band' WHEN 3 THEN ' iPad'
                       WHEN 4 THEN ' Gear S' ELSE '' END || ' ' || {text(f"{_k} % 50")} AS model,
        '256GB 8GB RAM' AS configuration,
        '$ ' || {text("1000 + p_size")} || '.00' AS price
      FROM part WHERE {_k} % 7 = 1) q"""

_SPACED = {c.replace(" ", "_").lower(): c for c in RAW_INPUT_COLUMNS}


def star_ctes(*more: tuple[str, str]) -> str:
    """WITH clause for a check: the star tables, then any further named queries."""
    parts = [f"{n} AS ({q})" for n, q in [*STAR_SQL.items(), *more]]
    return "WITH " + ",\n".join(parts) + "\n"


def raw_ctes(*more: tuple[str, str]) -> str:
    parts = [f"{n} AS ({q})" for n, q in [("raw", RAW_SQL), ("prices", PRICES_SQL), *more]]
    return "WITH " + ",\n".join(parts) + "\n"


class DerivedStar:
    """The star tables, each derived when first read. Stands in for `schemas.Star`."""

    def __init__(self, inputs: Inputs):
        self._inputs = inputs

    def __getattr__(self, name: str) -> DataFrame:
        if name not in STAR_SQL:
            raise AttributeError(name)
        table = self._inputs.derive(STAR_SQL[name])
        setattr(self, name, table)
        return table

    def register(self) -> None:
        for name in STAR_SQL:
            getattr(self, name).createOrReplaceTempView(name)


class Inputs:
    """Tables of one data folder, loaded when first asked for.

    With `dealt` the raw pages come in many tasks and in no order; else in the order of the file.
    """

    def __init__(self, spark: SparkSession, root: str, dealt: bool = False):
        self.spark, self.root, self.dealt = spark, root.rstrip("/"), dealt

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A table whose rows cost far more than reading them, dealt over all cores.

        A small file is one task, or a few, however many rows it holds; three tasks a core even out the rest.
        """
        return self.table(name).repartition(3 * self.spark.sparkContext.defaultParallelism)

    def derive(self, sql: str, spread: bool = False) -> DataFrame:
        for name in TABLES:
            if f" {name}" in sql:
                (self.spread if spread else self.table)(name).createOrReplaceTempView(name)
        return self.spark.sql(sql)

    @cached_property
    def star(self) -> DerivedStar:
        return DerivedStar(self)

    @cached_property
    def raw(self) -> DataFrame:
        """Raw specs under plain lower-case names."""
        return self.derive(RAW_SQL, spread=self.dealt)

    @cached_property
    def raw_pages(self) -> DataFrame:
        """Raw specs under the names of real pages."""
        return self.raw.withColumnsRenamed(_SPACED)

    @cached_property
    def prices(self) -> DataFrame:
        return self.derive(PRICES_SQL).toDF("seq", "Model", "Configuration", "Price")
