"""Catalogue analytics over the product star (A, W, T03, T04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import ranking
from ..operators.joins import join_dim, left_join_dim
from ..plans import analytics as plans
from ..plans.recommend import Request, list_brands, list_os, recommend
from .inputs import star_ctes
from .registry import query, sig, sig_sql

PHONE = "d.form_factor = 'phone'"
NAMED = "Device d JOIN Device_Name dn ON dn.id = d.device_name_id"


@query("brand_summary", star_ctes() + f"""
    SELECT dn.brand, COUNT(*) AS device_count, ROUND(AVG(d.price_eur), 2) AS avg_price_eur,
           MIN(d.year) AS first_year, MAX(d.year) AS last_year
    FROM {NAMED} WHERE {PHONE} AND d.price_eur IS NOT NULL
    GROUP BY dn.brand HAVING COUNT(*) >= 3""")
def _(i):
    return plans.brand_summary(i.star)


@query("annual_launches", star_ctes() + f"""
    SELECT d.year, COUNT(*) AS launches, ROUND(AVG(d.price_eur), 2) AS avg_price_eur,
           ROUND(AVG(d.battery_capacity_mah)) AS avg_battery_mah, ROUND(AVG(p.ram_gb), 2) AS avg_ram_gb,
           ROUND(AVG(p.internal_storage_gb), 2) AS avg_storage_gb
    FROM Device d LEFT JOIN Platform p ON p.id = d.platform_id
    WHERE {PHONE} AND d.year BETWEEN 2010 AND 2030 GROUP BY d.year""")
def _(i):
    return plans.annual_launches(i.star, until=2030)


@query("chipset_popularity", star_ctes() + f"""
    SELECT p.chipset_manufacturer, COUNT(*) AS device_count
    FROM Device d JOIN Platform p ON p.id = d.platform_id
    WHERE {PHONE} GROUP BY 1 ORDER BY device_count DESC, 1 LIMIT 15""")
def _(i):
    return plans.chipset_popularity(i.star)


@query("price_vs_battery", star_ctes() + f"""
    SELECT dn.brand, d.price_eur, d.battery_capacity_mah AS battery_mah, p.ram_gb, d.year
    FROM {NAMED} JOIN Platform p ON p.id = d.platform_id
    WHERE {PHONE} AND d.price_eur IS NOT NULL AND d.battery_capacity_mah IS NOT NULL""")
def _(i):
    return plans.price_vs_battery(i.star)


@query("ram_distribution", star_ctes() + f"""
    SELECT p.ram_gb, COUNT(*) AS device_count FROM Device d JOIN Platform p ON p.id = d.platform_id
    WHERE {PHONE} GROUP BY 1""")
def _(i):
    return plans.ram_distribution(i.star)


def _share(label, condition):
    return (f"SELECT '{label}' AS generation, COUNT(*) FILTER (WHERE {condition}) AS device_count, "
            f"COALESCE(ROUND(100.0e0 * COUNT(*) FILTER (WHERE {condition}) / NULLIF(COUNT(*), 0), 2), 0) AS pct FROM tech")


@query("network_technology", star_ctes(("tech", f"""
    SELECT nt.technology AS t FROM Device d JOIN Network_Technology nt ON nt.id = d.network_technology_id
    WHERE {PHONE}""")) + " UNION ALL ".join([
        _share("2G", "t LIKE '%GSM%' OR t LIKE '%CDMA%'"),
        _share("3G", "t LIKE '%HSPA%' OR t LIKE '%EVDO%' OR t LIKE '%CDMA2000%'"),
        _share("4G", "t LIKE '%LTE%'"), _share("5G", "t LIKE '%5G%'")]))
def _(i):
    return plans.network_technology(i.star)


@query("sim_type_distribution", star_ctes() + f"""
    SELECT s.sim_type, COUNT(*) AS device_count FROM Device d JOIN Sim s ON s.id = d.sim_id
    WHERE {PHONE} GROUP BY 1""")
def _(i):
    return plans.sim_type_distribution(i.star)


@query("top_android_versions", star_ctes() + f"""
    SELECT o.os_version, COUNT(*) AS device_count FROM Device d JOIN OS o ON o.id = d.os_id
    WHERE {PHONE} AND o.os_name = 'Android' AND o.os_version IS NOT NULL
    GROUP BY 1 ORDER BY device_count DESC, 1 LIMIT 5""")
def _(i):
    return plans.top_android_versions(i.star, 5)


@query("ppi_trend", star_ctes(("top3", f"""
    SELECT dn.brand FROM {NAMED} WHERE {PHONE} GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 3""")) + f"""
    SELECT dn.brand, d.year, ROUND(AVG(x.ppi_density), 2) AS avg_ppi, COUNT(*) AS device_count
    FROM {NAMED} JOIN Display x ON x.id = d.display_id
    WHERE {PHONE} AND dn.brand IN (SELECT brand FROM top3) AND x.ppi_density IS NOT NULL GROUP BY 1, 2""")
def _(i):
    return plans.ppi_trend(i.star)


_BASE = """
    SELECT d.weight, d.length, d.width, d.height, d.volume, d.battery_capacity_mah AS battery_mah, d.price_eur,
           x.display_size_inch, x.screen_to_body_ratio, x.resolution_pixels, x.ppi_density,
           p.cpu_core_count, p.internal_storage_gb, p.ram_gb
    FROM Device d LEFT JOIN Display x ON x.id = d.display_id LEFT JOIN Platform p ON p.id = d.platform_id
    WHERE d.form_factor = 'phone'"""


@query("correlation_matrix", star_ctes(("b", _BASE)) + " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, CASE WHEN isnan(corr({a}, {b})) THEN NULL "
    f"ELSE round(corr({a}, {b}), 3) END AS r FROM b" for a in plans.CORRELATED for b in plans.CORRELATED))
def _(i):
    return plans.correlation_matrix(i.star)


@query("histogram", star_ctes(("v", f"SELECT price_eur AS x FROM Device d WHERE {PHONE} AND price_eur IS NOT NULL"),
                              ("e", "SELECT MIN(x) AS lo, MAX(x) AS hi, (MAX(x) - MIN(x)) / 20 AS w FROM v")) + """
    SELECT LEAST(CAST(FLOOR((x - lo) / w) AS INT), 19) AS bin,
           lo + LEAST(CAST(FLOOR((x - lo) / w) AS INT), 19) * w AS bin_start,
           lo + (LEAST(CAST(FLOOR((x - lo) / w) AS INT), 19) + 1) * w AS bin_end, COUNT(*) AS n
    FROM v, e GROUP BY 1, 2, 3""")
def _(i):
    return agg.histogram(i.star.Device.filter("form_factor = 'phone'"), "price_eur", 20)


@query("quartiles", star_ctes() + """
    SELECT form_factor, quantile_cont(price_eur, 0.25) AS q1, quantile_cont(price_eur, 0.5) AS median,
           quantile_cont(price_eur, 0.75) AS q3 FROM Device GROUP BY 1""")
def _(i):
    return agg.quartiles(i.star.Device, "price_eur", ["form_factor"])


_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS x FROM b WHERE {c} IS NOT NULL" for c in plans.DISTRIBUTED)


@query("quantitative_distributions", star_ctes(("b", _BASE), ("v", _LONG), ("e", """
    SELECT "column", MIN(x) AS lo, MAX(x) AS hi, (MAX(x) - MIN(x)) / 20 AS w FROM v GROUP BY 1""")) + """
    SELECT v."column", LEAST(CAST(FLOOR((x - lo) / w) AS INT), 19) AS bin,
           lo + LEAST(CAST(FLOOR((x - lo) / w) AS INT), 19) * w AS bin_start,
           lo + (LEAST(CAST(FLOOR((x - lo) / w) AS INT), 19) + 1) * w AS bin_end, COUNT(*) AS n
    FROM v JOIN e USING ("column") GROUP BY 1, 2, 3, 4""")
def _(i):
    return plans.quantitative_distributions(i.star)


@query("quantitative_quartiles", star_ctes(("b", _BASE), ("v", _LONG)) + """
    SELECT "column", quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3
    FROM v GROUP BY 1""")
def _(i):
    return plans.quantitative_quartiles(i.star)


@query("available_years", star_ctes() + f"SELECT DISTINCT year FROM Device d WHERE {PHONE}")
def _(i):
    return plans.available_years(i.star)


@query("resolve_year", star_ctes() + f"SELECT MAX(year) AS year FROM Device d WHERE {PHONE}")
def _(i):
    return agg.resolve_year(i.star.Device.filter("form_factor = 'phone'"))


@query("top_brands", star_ctes() + f"""
    SELECT dn.brand, COUNT(*) AS n FROM {NAMED} WHERE {PHONE} GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5""")
def _(i):
    return plans.top_brands(i.star, 5)


@query("group_summary", star_ctes() + f"""
    SELECT dn.brand, COUNT(*) AS n, {sig_sql("AVG(d.price_eur)")} AS mean,
           {sig_sql("CASE WHEN COUNT(*) > 1 THEN STDDEV_SAMP(d.price_eur) END")} AS std,
           quantile_cont(d.price_eur, 0.5) AS median
    FROM {NAMED} WHERE d.price_eur IS NOT NULL GROUP BY 1""")
def _(i):
    rows = join_dim(i.star.Device, i.star.Device_Name, "device_name_id", ["brand"])
    out = agg.group_summary(rows, ["brand"], "price_eur")
    return out.withColumn("mean", sig(F.col("mean"))).withColumn("std", sig(F.col("std")))


@query("count_where", star_ctes() + f"SELECT COUNT(*) AS n FROM Device d WHERE {PHONE} AND d.price_eur < 200")
def _(i):
    return agg.count_where(i.star.Device, (F.col("form_factor") == "phone") & (F.col("price_eur") < 200))


@query("value_counts", star_ctes() + "SELECT launch_status, COUNT(*) AS n FROM Device GROUP BY 1")
def _(i):
    return agg.value_counts(i.star.Device, "launch_status")


@query("unresolved_counts", star_ctes() + """
    SELECT COUNT(*) FILTER (WHERE network_technology_id IS NULL) AS network_technology_id,
           COUNT(*) FILTER (WHERE camera_id IS NULL) AS camera_id,
           COUNT(*) FILTER (WHERE platform_id IS NULL) AS platform_id,
           COUNT(*) FILTER (WHERE sim_id IS NULL) AS sim_id,
           COUNT(*) FILTER (WHERE network_technology_id IS NULL OR camera_id IS NULL OR platform_id IS NULL
                            OR sim_id IS NULL) AS rows_with_gaps FROM Device""")
def _(i):
    return agg.unresolved_counts(i.star.Device, ["network_technology_id", "camera_id", "platform_id", "sim_id"])


@query("yearly_avg", star_ctes() + f"""
    SELECT year, ROUND(AVG(price_eur), 2) AS avg FROM Device d
    WHERE {PHONE} AND year >= 2019 AND price_eur IS NOT NULL GROUP BY 1""")
def _(i):
    return agg.yearly_avg(i.star.Device.filter("form_factor = 'phone'"), "price_eur", 2019)


@query("top_expensive_products", star_ctes(("ranked", f"""
    SELECT dn.brand, dn.model, d.year, d.price_eur, o.os_name, o.os_version,
           ROW_NUMBER() OVER (PARTITION BY dn.brand, dn.model ORDER BY d.price_eur DESC, d.year,
                              o.os_name NULLS LAST, o.os_version NULLS LAST) AS rn
    FROM {NAMED} LEFT JOIN OS o ON o.id = d.os_id WHERE {PHONE} AND d.price_eur IS NOT NULL""")) + """
    SELECT brand, model, year, price_eur, os_name, os_version FROM ranked WHERE rn = 1
    ORDER BY price_eur DESC, brand, model LIMIT 50""")
def _(i):
    return plans.top_expensive(i.star)


@query("best_per_top_brands", star_ctes(("top5", f"""
    SELECT dn.brand FROM {NAMED} WHERE {PHONE} GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 5"""), ("ranked", f"""
    SELECT dn.brand, dn.model, d.price_eur,
           ROW_NUMBER() OVER (PARTITION BY dn.brand ORDER BY d.price_eur DESC, dn.model) AS rn
    FROM {NAMED} WHERE {PHONE} AND d.price_eur IS NOT NULL AND dn.brand IN (SELECT brand FROM top5)""")) + """
    SELECT brand, model, price_eur FROM ranked WHERE rn = 1""")
def _(i):
    return plans.best_per_top_brand(i.star)


@query("top_per_period", star_ctes(("c", """
    SELECT d.year, p.chipset_manufacturer, COUNT(*) AS launches,
           ROW_NUMBER() OVER (PARTITION BY d.year ORDER BY COUNT(*) DESC, p.chipset_manufacturer) AS rn
    FROM Device d JOIN Platform p ON p.id = d.platform_id GROUP BY 1, 2""")) + """
    SELECT year, chipset_manufacturer, launches FROM c WHERE rn = 1""")
def _(i):
    rows = join_dim(i.star.Device, i.star.Platform, "platform_id", ["chipset_manufacturer"])
    return ranking.top_per_period(rows, "year", "chipset_manufacturer")


@query("last_turns", """
    WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations)
    SELECT conv_id, turn, role, text, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) AS place
    FROM r WHERE back <= 3""")
def _(i):
    return ranking.last_n_per_session(i.table("conversations"), "conv_id", "turn", 3)


@query("session_messages", """
    WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations),
         k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM r WHERE back <= 3)
    SELECT conv_id, place, 0 AS part, 'user' AS role, '(earlier question) ' || text AS content FROM k
    UNION ALL
    SELECT conv_id, place, 1, 'assistant', '(my earlier answer)' || chr(10) || '```sql' || chr(10) || role || chr(10)
           || '```' || chr(10) || 'That query produced this preview:' || chr(10) || CAST(turn AS VARCHAR) FROM k""")
def _(i):
    turns = ranking.last_n_per_session(i.table("conversations"), "conv_id", "turn", 3)
    return ranking.session_messages(turns.withColumn("shown", F.col("turn").cast("string")),
                                    "conv_id", "text", "role", "shown")


_ORDER = "brand, model, year, form_factor, ram_gb NULLS LAST, storage_gb NULLS LAST, battery_mah NULLS LAST, " \
         "display_inch NULLS LAST, os NULLS LAST, chipset NULLS LAST, network NULLS LAST"
_RECOMMEND = """
    SELECT d.id AS device_id, dn.brand, dn.model, d.year, d.form_factor, d.price_eur, p.ram_gb,
           p.internal_storage_gb AS storage_gb, d.battery_capacity_mah AS battery_mah,
           x.display_size_inch AS display_inch, o.os_name AS os, p.chipset_manufacturer AS chipset,
           nt.technology AS network
    FROM Device d JOIN Device_Name dn ON dn.id = d.device_name_id LEFT JOIN Platform p ON p.id = d.platform_id
    LEFT JOIN Display x ON x.id = d.display_id LEFT JOIN OS o ON o.id = d.os_id
    LEFT JOIN Network_Technology nt ON nt.id = d.network_technology_id"""


@query("recommend_default", star_ctes() + _RECOMMEND + f"""
    WHERE d.form_factor = 'phone' AND d.price_eur IS NOT NULL
    ORDER BY price_eur, device_id, {_ORDER} LIMIT 50""")
def _(i):
    return recommend(i.star, Request())


@query("recommend_filtered", star_ctes() + _RECOMMEND + f"""
    WHERE d.price_eur <= 700 AND dn.brand IN ('Brand#1', 'Brand#7', 'Brand#12') AND o.os_name = 'Android'
      AND p.ram_gb >= 4 AND p.internal_storage_gb >= 128 AND d.battery_capacity_mah >= 1000
      AND x.display_size_inch >= 4 AND x.display_size_inch <= 7.5 AND nt.technology LIKE '%5G%'
    ORDER BY battery_mah DESC, device_id, brand, model, year, form_factor, price_eur NULLS LAST, {_ORDER} LIMIT 25""")
def _(i):
    return recommend(i.star, Request(
        max_price_eur=700, brands=["Brand#1", "Brand#7", "Brand#12"], os_name="Android", min_ram_gb=4,
        min_storage_gb=128, min_battery_mah=1000, min_display_inch=4, max_display_inch=7.5, require_5g=True,
        form_factor="any", sort_by="battery", sort_order="desc", limit=25))


@query("list_brands", star_ctes() + "SELECT DISTINCT brand FROM Device_Name")
def _(i):
    return list_brands(i.star)


@query("list_os", star_ctes() + "SELECT DISTINCT os_name FROM OS WHERE os_name IS NOT NULL")
def _(i):
    return list_os(i.star)


@query("recommend_star", star_ctes() + """
    SELECT o.os_name, p.chipset_manufacturer, COUNT(*) AS n, COUNT(x.display_size_inch) AS with_display
    FROM Device d JOIN Device_Name dn ON dn.id = d.device_name_id LEFT JOIN Platform p ON p.id = d.platform_id
    LEFT JOIN Display x ON x.id = d.display_id LEFT JOIN OS o ON o.id = d.os_id
    LEFT JOIN Network_Technology nt ON nt.id = d.network_technology_id GROUP BY 1, 2""")
def _(i):
    from ..operators.joins import recommend_star

    return recommend_star(i.star).groupBy("os_name", "chipset_manufacturer").agg(
        F.count("*").alias("n"), F.count("display_size_inch").alias("with_display"))


@query("full_star", star_ctes() + """
    SELECT o.os_name, s.sim_type, COUNT(*) AS n, CAST(SUM(c.main_cameras_num) AS BIGINT) AS cameras,
           CAST(SUM(x.resolution_pixels) AS BIGINT) AS pixels
    FROM Device d JOIN Device_Name dn ON dn.id = d.device_name_id JOIN Platform p ON p.id = d.platform_id
    JOIN Display x ON x.id = d.display_id JOIN OS o ON o.id = d.os_id JOIN Camera c ON c.id = d.camera_id
    JOIN Sim s ON s.id = d.sim_id JOIN Network_Technology nt ON nt.id = d.network_technology_id GROUP BY 1, 2""")
def _(i):
    from ..operators.joins import full_star

    return full_star(i.star).groupBy("os_name", "sim_type").agg(
        F.count("*").alias("n"), F.sum("main_cameras_num").alias("cameras"), F.sum("resolution_pixels").alias("pixels"))


@query("join_inner_dim", star_ctes() + """
    SELECT p.chipset_manufacturer, COUNT(*) AS n FROM Device d JOIN Platform p ON p.id = d.platform_id GROUP BY 1""")
def _(i):
    return join_dim(i.star.Device, i.star.Platform, "platform_id", ["chipset_manufacturer"]).groupBy(
        "chipset_manufacturer").agg(F.count("*").alias("n"))


@query("join_left_dim", star_ctes() + """
    SELECT p.chipset_manufacturer, COUNT(*) AS n FROM Device d LEFT JOIN Platform p ON p.id = d.platform_id
    GROUP BY 1""")
def _(i):
    return left_join_dim(i.star.Device, i.star.Platform, "platform_id", ["chipset_manufacturer"]).groupBy(
        "chipset_manufacturer").agg(F.count("*").alias("n"))
