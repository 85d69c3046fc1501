"""Star load, constraint checks and the incremental job."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, load, quality
from ..operators.ranking import first_per_key
from ..plans import clean as plan
from ..schemas import CHECK_RULES, SIGNATURE_COLUMNS, STAR_SCHEMAS, UNIQUE_KEYS, Star
from ..session import scratch_path, store
from ..streaming.incremental import appended, incremental_append, incremental_load
from .cleaning import CHAIN, EXPANDED, LISTED, PIECES, PRICED, STAGED
from .inputs import Inputs, raw_ctes, star_ctes
from .registry import query

C = F.col


def _key(expr: str, numeric: bool = False) -> str:
    if not numeric:
        return f"COALESCE(lower(trim({expr})), '__missing__')"
    return (f"CASE WHEN {expr} IS NULL THEN '__missing__' WHEN {expr} = floor({expr}) "
            f"THEN CAST(CAST({expr} AS BIGINT) AS VARCHAR) ELSE printf('%g', CAST({expr} AS DOUBLE)) END")


def _staged(i: Inputs):
    """Staged rows of the large table: typed dimension columns with odd spellings and gaps."""
    rows = joins.join_dim(i.star.Device, i.star.Device_Name, "device_name_id", ["brand", "model"])
    rows = joins.left_join_dim(rows, i.star.Platform, "platform_id",
                               ["chipset_manufacturer", "cpu_core_count", "internal_storage_gb", "ram_gb"])
    rows = joins.left_join_dim(rows, i.star.Sim, "sim_id", ["sim_count", "sim_type"])
    odd = F.when(C("id") % 3 == 0, F.upper("brand")).when(C("id") % 3 == 1, F.concat(F.lit(" "), "brand")).otherwise(C("brand"))
    return rows.withColumn("brand", odd)


STAGED_STAR = ("s", """
    SELECT d.id, CASE d.id % 3 WHEN 0 THEN upper(dn.brand) WHEN 1 THEN ' ' || dn.brand ELSE dn.brand END AS brand, dn.model,
           p.chipset_manufacturer, p.cpu_core_count, p.internal_storage_gb, p.ram_gb, x.sim_count, x.sim_type,
           d.year, d.price_eur
    FROM Device d JOIN Device_Name dn ON dn.id = d.device_name_id LEFT JOIN Platform p ON p.id = d.platform_id
    LEFT JOIN Sim x ON x.id = d.sim_id""")


@query("dim_device_name", star_ctes(STAGED_STAR) + f"""
    SELECT DISTINCT {_key('brand')} AS brand_key, {_key('model')} AS model_key FROM s""")
def _(i):
    rows = load.dimension_rows(_staged(i), "Device_Name", "id")
    return rows.select(F.lower(F.trim("brand")).alias("brand_key"), F.lower(F.trim("model")).alias("model_key"))


@query("dim_sim", star_ctes(STAGED_STAR) + """
    SELECT DISTINCT sim_count, sim_type FROM s WHERE sim_count IS NOT NULL AND sim_type IS NOT NULL""")
def _(i):
    return load.dimension_rows(_staged(i), "Sim", "id")


@query("dim_platform", star_ctes(STAGED_STAR) + """
    SELECT DISTINCT chipset_manufacturer, cpu_core_count, internal_storage_gb, ram_gb FROM s
    WHERE chipset_manufacturer IS NOT NULL""")
def _(i):
    return load.dimension_rows(_staged(i), "Platform", "id")


@query("dim_display", raw_ctes(PIECES, EXPANDED, LISTED, PRICED, CHAIN, ("d", """
    SELECT inch AS display_size_inch, pixels AS resolution_pixels, part_id FROM chain""")) + """
    SELECT display_size_inch, resolution_pixels, COUNT(*) AS n FROM d
    GROUP BY 1, 2""")
def _(i):
    rows = load.stage(plan.clean(i.raw_pages, i.prices, impute=False))
    helpers = joins.key_columns(rows, ["display_size_inch", "resolution_pixels"])
    grouped = rows.withColumns(helpers).groupBy(*helpers).agg(
        F.first("display_size_inch").alias("display_size_inch"), F.first("resolution_pixels").alias("resolution_pixels"),
        F.count("*").alias("n"))
    return grouped.drop(*helpers)


@query("unseen_rows", """
    WITH r AS (SELECT p_partkey, p_brand, p_name, ROW_NUMBER() OVER (
                 PARTITION BY lower(trim(p_brand)), lower(trim(p_name)) ORDER BY p_partkey) AS rn FROM part)
    SELECT p_partkey, p_brand, p_name FROM r
    WHERE rn = 1 AND (p_brand, p_name) NOT IN (SELECT p_brand, p_name FROM part WHERE p_size = 7)""")
def _(i):
    part = i.table("part").select("p_partkey", "p_brand", "p_name")
    stored = i.table("part").filter("p_size = 7").select(F.upper("p_brand").alias("p_brand"), "p_name")
    return load.unseen(part, stored, ["p_brand", "p_name"], "p_partkey")


@query("assign_ids", """
    SELECT 1000 + ROW_NUMBER() OVER (ORDER BY md5(lower(p_brand) || '|' || lower(p_name))) AS id, p_brand, p_name
    FROM (SELECT DISTINCT p_brand, p_name FROM part) q""")
def _(i):
    names = i.table("part").select("p_brand", "p_name").distinct()
    return load.assign_ids(names, ["p_brand", "p_name"], start=1000)


@query("fact_lookup_ids", star_ctes(STAGED_STAR, ("pl", """
    SELECT chipset_manufacturer AS a, cpu_core_count AS b, internal_storage_gb AS c, ram_gb AS e,
           ROW_NUMBER() OVER (ORDER BY md5(lower(chipset_manufacturer) || '|' || cpu_core_count || '|' ||
                              internal_storage_gb || '|' || ram_gb)) AS pid
    FROM (SELECT DISTINCT chipset_manufacturer, cpu_core_count, internal_storage_gb, ram_gb FROM s
          WHERE chipset_manufacturer IS NOT NULL) q""")) + """
    SELECT s.id, s.year, s.price_eur, pl.pid AS platform_id FROM s LEFT JOIN pl ON pl.a = s.chipset_manufacturer
      AND pl.b = s.cpu_core_count AND pl.c = s.internal_storage_gb AND pl.e = s.ram_gb""")
def _(i):
    staged = _staged(i)
    dim = load.assign_ids(load.dimension_rows(staged, "Platform", "id"), UNIQUE_KEYS["Platform"])
    out = joins.attach_lookup_id(staged, dim, UNIQUE_KEYS["Platform"], "platform_id")
    return out.select("id", "year", "price_eur", "platform_id")


@query("fact_signatures", star_ctes() + "SELECT id, year, price_eur, sha256(concat_ws('|', " + ", ".join(
    _key(c, c not in ("launch_status", "form_factor")) for c in SIGNATURE_COLUMNS) + ")) AS device_key FROM Device")
def _(i):
    from ..functions import row_signature

    d = i.star.Device
    return d.select("id", "year", "price_eur", row_signature(d, SIGNATURE_COLUMNS).alias("device_key"))


def _load(i: Inputs, target: str, times: int = 1):
    staged = load.stage(plan.clean(i.raw_pages, i.prices, impute=False))
    staged = store(staged.withColumnRenamed("part_id", "at"), "staged")
    for _run in range(times):
        load.load_star(i.spark, target, staged, "at")


_COUNTS = raw_ctes(PIECES, EXPANDED, LISTED, PRICED, CHAIN, STAGED, ("t", f"""
    SELECT *, {_key('brand')} || '/' || {_key('model')} AS name_key, {_key('os_name')} || '/' || {_key('os_version')} AS os_key,
           {_key('chipset_manufacturer')} || '/' || {_key('cpu_core_count', True)} || '/' || {_key('internal_storage_gb', True)}
             || '/' || {_key('ram_gb', True)} AS platform_key FROM staged"""))


@query("load_star_twice", _COUNTS + """
    SELECT 'Device_Name' AS tab, COUNT(DISTINCT name_key) AS n FROM t
    UNION ALL SELECT 'OS', COUNT(DISTINCT os_key) FROM t WHERE os_name IS NOT NULL OR os_version IS NOT NULL
    UNION ALL SELECT 'Platform', COUNT(DISTINCT platform_key) FROM t WHERE chipset_manufacturer IS NOT NULL
        AND cpu_core_count IS NOT NULL AND internal_storage_gb IS NOT NULL AND ram_gb IS NOT NULL
    UNION ALL SELECT 'Sim', COUNT(*) FROM (SELECT DISTINCT sim_count, sim_type FROM t
        WHERE sim_count IS NOT NULL AND sim_type IS NOT NULL) q""")
def _(i):
    target = scratch_path(i.spark, "star-load")
    _load(i, target, times=2)
    out = None
    for name in ("Device_Name", "OS", "Platform", "Sim"):
        one = load.open_target(i.spark, target, name).agg(F.count("*").alias("n")).withColumn("tab", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


# A version that reads as a number is keyed as that number.
_VERSION = f"CASE WHEN regexp_matches(os_version, '^[0-9]+([.][0-9]+)?$') THEN printf('%g', CAST(os_version AS DOUBLE)) ELSE {_key('os_version')} END"


_DEVICES = _COUNTS + f"""
    SELECT DISTINCT name_key, CASE WHEN os_name IS NOT NULL OR os_version IS NOT NULL THEN {_key('os_name')} || '/' || {_VERSION} END AS os_key,
        CASE WHEN chipset_manufacturer IS NOT NULL AND cpu_core_count IS NOT NULL AND internal_storage_gb IS NOT NULL
             AND ram_gb IS NOT NULL THEN platform_key END AS platform_key,
        CASE WHEN sim_count IS NOT NULL AND sim_type IS NOT NULL THEN sim_count || '/' || sim_type END AS sim_key,
        year, battery_capacity_mah, launch_status, weight, round(price_eur, 6) AS price_eur FROM t"""


def _devices(i: Inputs, target: str):
    """The stored devices with the keys that their ids stand for."""
    rows = load.open_target(i.spark, target, "Device")
    for table, fk, name in (("Device_Name", "device_name_id", "name_key"), ("OS", "os_id", "os_key"),
                            ("Platform", "platform_id", "platform_key"), ("Sim", "sim_id", "sim_key")):
        dim = load.open_target(i.spark, target, table)
        key = F.concat_ws("/", *joins.key_columns(dim, UNIQUE_KEYS[table]).values())
        rows = rows.join(dim.select(C("id").alias(fk), key.alias(name)), fk, "left")
    return rows.select("name_key", "os_key", "platform_key", "sim_key", "year", "battery_capacity_mah", "launch_status", "weight",
                       F.round("price_eur", 6).alias("price_eur")).distinct()


@query("load_star_devices", _DEVICES)
def _(i):
    target = scratch_path(i.spark, "star-load")
    _load(i, target, times=2)
    return _devices(i, target)


@query("load_star_integrity")
def _(i):
    target = scratch_path(i.spark, "star-load")
    _load(i, target)
    star = Star(**{t: load.open_target(i.spark, target, t) for t in STAR_SCHEMAS})
    orphans = quality.check_fk(star.Device, "device_name_id", star.Device_Name).count()
    repeated = quality.check_unique(star.Device, ["device_key"]).count()
    broken = quality.check_rules(star.Device, CHECK_RULES["Device"], ["id"]).count()
    ids = star.Device.agg(F.count("*").alias("devices"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    return ids.withColumns({"orphans": F.lit(orphans), "repeated": F.lit(repeated), "broken_rules": F.lit(broken)})


# Rules that the derived tables do break, next to rules they keep.
_RULES = {
    "ck_price_cap": "price_eur <= 1000", "ck_battery_floor": "battery_capacity_mah > 150",
    "ck_year_range": "year BETWEEN 1995 AND 2030", "ck_no_watch": "form_factor IN ('phone', 'tablet')",
}


@query("check_rules", star_ctes() + " UNION ALL ".join(
    f"SELECT id, '{name}' AS rule FROM Device WHERE NOT COALESCE({cond}, true)" for name, cond in _RULES.items()))
def _(i):
    return quality.check_rules(i.star.Device, _RULES, ["id"])


@query("check_declared_rules", star_ctes() + " UNION ALL ".join(
    f"SELECT '{name}' AS tab, CAST(COALESCE(SUM(" + " + ".join(f"CASE WHEN {cond} THEN 0 WHEN NOT ({cond}) THEN 1 ELSE 0 END" for cond in rules.values())
    + f"), 0) AS INTEGER) AS broken FROM {name}" for name, rules in CHECK_RULES.items()))
def _(i):
    out = None
    for name, rules in CHECK_RULES.items():
        one = quality.check_rules(getattr(i.star, name), rules, ["id"]).agg(
            F.count("*").cast("int").alias("broken")).withColumn("tab", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("check_unique", """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def _(i):
    return quality.check_unique(i.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("check_not_null", star_ctes() + """
    SELECT id, 'platform_id' AS "column" FROM Device WHERE platform_id IS NULL
    UNION ALL SELECT id, 'price_eur' FROM Device WHERE price_eur IS NULL""")
def _(i):
    return quality.check_not_null(i.star.Device, ["platform_id", "price_eur", "year"], ["id"])


@query("check_foreign_key", star_ctes() + """
    SELECT id, platform_id FROM Device WHERE platform_id IS NOT NULL
      AND platform_id NOT IN (SELECT id FROM Platform WHERE ram_gb <> 3)""")
def _(i):
    return quality.check_fk(i.star.Device, "platform_id", i.star.Platform.filter("ram_gb <> 3")).select("id", "platform_id")


@query("check_still_referenced", star_ctes() + """
    SELECT id, os_name FROM OS WHERE id IN (SELECT os_id FROM Device WHERE price_eur > 1040)""")
def _(i):
    return quality.still_referenced(i.star.OS, i.star.Device.filter("price_eur > 1040"), "os_id").select("id", "os_name")


@query("incremental_append", """
    SELECT MIN(event_id) AS event_id, user_id, event_type FROM events GROUP BY 2, 3""")
def _(i):
    src, target, ckpt = (scratch_path(i.spark, k) for k in ("events-in", "events-out", "events-ckpt"))
    rows = i.table("events").select("event_id", "user_id", "event_type")
    # earlier rows arrive in earlier files; the first row of a key is the one that stays
    first = first_per_key(rows, ["user_id", "event_type"], "event_id")
    first.write.parquet(f"{src}/batch=1")
    incremental_append(i.spark, src, target, ckpt, rows.schema, ["user_id", "event_type"])
    rows.write.parquet(f"{src}/batch=2")
    for _run in range(2):
        incremental_append(i.spark, src, target, ckpt, rows.schema, ["user_id", "event_type"])
    return appended(i.spark, target, rows.schema)


@query("incremental_load", _DEVICES)
def _(i):
    src, target, ckpt = (scratch_path(i.spark, k) for k in ("raw-in", "raw-star", "raw-ckpt"))
    pages = i.raw_pages.drop("part_id")
    prices = store(i.prices, "prices")
    for half in (0, 1):
        part = i.raw_pages.filter(C("part_id") % 2 == half).select(*[f"`{c}`" for c in pages.columns])
        part.write.mode("append").parquet(src)
        incremental_load(i.spark, src, target, ckpt, prices, fmt="parquet")
    incremental_load(i.spark, src, target, ckpt, prices, fmt="parquet")
    return _devices(i, target)
