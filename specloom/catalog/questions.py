"""The question set and guarded ad-hoc SQL over the product star (Q, E, D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import adhoc, questions
from .inputs import star_ctes
from .registry import query, sig, sig_sql

B = "Brand#7"
N = "Device d JOIN Device_Name dn ON dn.id = d.device_name_id"
P = "JOIN Platform p ON p.id = d.platform_id"
NT = "JOIN Network_Technology nt ON nt.id = d.network_technology_id"
PH = "d.form_factor = 'phone'"

SQL = {
    "q01": f"""SELECT dn.brand, dn.model, d.year, d.price_eur FROM {N} WHERE dn.brand = '{B}' AND {PH} AND d.year = 2023
        AND d.price_eur IS NOT NULL ORDER BY d.price_eur, model LIMIT 5""",
    "q02": f"""SELECT dn.brand, dn.model, p.ram_gb, d.price_eur FROM {N} {P} WHERE {PH} AND p.ram_gb >= 12
        ORDER BY p.ram_gb DESC, brand, model, price_eur NULLS LAST LIMIT 10""",
    "q03": f"SELECT COUNT(*) AS n FROM Device d WHERE {PH} AND d.price_eur < 200",
    "q04": f"""SELECT dn.brand, dn.model, d.price_eur FROM {N} WHERE {PH} AND d.price_eur IS NOT NULL
        ORDER BY d.price_eur DESC, brand, model LIMIT 1""",
    "q05": f"""SELECT dn.brand, COUNT(*) AS device_count, ROUND(AVG(d.price_eur), 2) AS avg_price_eur FROM {N}
        WHERE {PH} AND d.price_eur IS NOT NULL GROUP BY dn.brand HAVING COUNT(*) >= 10""",
    "q06": f"""SELECT dn.brand, ROUND(AVG(d.price_eur), 2) AS avg_price_eur FROM {N} WHERE {PH} AND d.price_eur IS NOT NULL
        GROUP BY dn.brand ORDER BY avg_price_eur DESC, brand LIMIT 5""",
    "q07": f"SELECT dn.brand, COUNT(*) AS device_count FROM {N} WHERE {PH} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "q08": f"""SELECT p.chipset_manufacturer, ROUND(AVG(d.battery_capacity_mah)) AS avg_battery_mah FROM Device d {P}
        WHERE {PH} AND d.battery_capacity_mah IS NOT NULL AND p.chipset_manufacturer IS NOT NULL GROUP BY 1""",
    "q09": f"SELECT COUNT(*) AS n FROM Device d {NT} WHERE {PH} AND nt.technology LIKE '%5G%'",
    "q10": f"""SELECT dn.brand, dn.model, p.ram_gb, d.price_eur FROM {N} {P} {NT} WHERE {PH} AND nt.technology LIKE '%5G%'
        AND p.ram_gb >= 8 AND d.price_eur IS NOT NULL ORDER BY d.price_eur, brand, model, ram_gb LIMIT 5""",
    "q11": f"SELECT d.year, COUNT(*) AS launches FROM Device d WHERE {PH} AND d.year BETWEEN 2020 AND 2024 GROUP BY 1",
    "q12": f"""SELECT d.year, ROUND(AVG(p.ram_gb), 2) AS avg_ram_gb FROM Device d {P} WHERE {PH} AND d.year >= 2018
        AND p.ram_gb IS NOT NULL GROUP BY 1""",
    "q13": f"SELECT COUNT(*) AS n FROM Device d WHERE {PH} AND d.price_eur IS NULL",
    "q14": f"SELECT COUNT(*) AS n FROM Device d WHERE {PH} AND d.platform_id IS NULL",
    "q15": f"""SELECT brand, model, price_eur FROM (SELECT dn.brand, dn.model, d.price_eur,
        ROW_NUMBER() OVER (PARTITION BY dn.brand ORDER BY d.price_eur DESC, dn.model) AS rn FROM {N}
        WHERE {PH} AND d.price_eur IS NOT NULL AND dn.brand IN (SELECT y.brand FROM Device x JOIN Device_Name y
          ON y.id = x.device_name_id WHERE x.form_factor = 'phone' GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 5)) q WHERE rn = 1""",
    "q16": f"""SELECT dn.brand, dn.model, p.chipset_manufacturer, p.ram_gb, c.highest_maincam_res FROM {N} {P}
        JOIN Camera c ON c.id = d.camera_id WHERE dn.brand = '{B}' AND {PH}
        ORDER BY model, brand, chipset_manufacturer, ram_gb, highest_maincam_res NULLS LAST LIMIT 10""",
    "q17": "SELECT COUNT(*) AS n FROM Device d WHERE d.form_factor = 'watch'",
    "q18": "SELECT COUNT(*) AS n FROM Device d WHERE d.form_factor = 'tablet'",
    "q19": f"""SELECT o.os_name, COUNT(*) AS device_count FROM Device d JOIN OS o ON o.id = d.os_id WHERE {PH}
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "q20": f"""SELECT p.chipset_manufacturer, COUNT(*) AS device_count FROM Device d {P} WHERE {PH}
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "q21": f"""SELECT ROUND(AVG(x.display_size_inch), 2) AS avg_inch FROM Device d JOIN Display x ON x.id = d.display_id
        WHERE {PH} AND d.year = 2024""",
    "q22": f"SELECT COUNT(*) AS n FROM Device d JOIN Sim s ON s.id = d.sim_id WHERE {PH} AND s.sim_count = 'dual'",
    "q23": f"""SELECT dn.brand, dn.model, p.internal_storage_gb, d.price_eur FROM {N} {P} WHERE {PH}
        AND p.internal_storage_gb >= 256 AND d.price_eur IS NOT NULL ORDER BY d.price_eur, brand, model LIMIT 1""",
    "q24": f"""SELECT dn.brand, dn.model, d.year, p.ram_gb FROM {N} {P} WHERE dn.brand = '{B}' AND {PH} AND p.ram_gb >= 8
        ORDER BY d.year DESC, brand, model, ram_gb LIMIT 100""",
    "q25": f"""SELECT d.year, ROUND(AVG(d.price_eur), 2) AS avg_price_eur FROM Device d WHERE {PH} AND d.year >= 2015
        AND d.price_eur IS NOT NULL GROUP BY 1""",
    "e01": f"""SELECT dn.brand, dn.model, d.year, d.price_eur, p.ram_gb, p.internal_storage_gb AS storage_gb,
        d.battery_capacity_mah, c.highest_maincam_res FROM {N} {P} JOIN Camera c ON c.id = d.camera_id
        WHERE {PH} AND d.price_eur IS NOT NULL AND d.year >= 2023
        ORDER BY p.ram_gb DESC, d.battery_capacity_mah DESC NULLS LAST, c.highest_maincam_res DESC NULLS LAST, brand, model, d.year,
        d.price_eur LIMIT 10""",
    "e02": f"""SELECT dn.brand, dn.model, d.year, d.price_eur, p.ram_gb, p.internal_storage_gb AS storage_gb FROM {N} {P}
        WHERE dn.brand = '{B}' AND {PH} AND d.price_eur < 800 AND d.year >= 2022
        ORDER BY d.price_eur, brand, model, d.year, ram_gb, storage_gb LIMIT 100""",
    "e03": f"""SELECT dn.brand, dn.model, d.year, p.ram_gb, d.price_eur, nt.technology FROM {N} {P} {NT}
        WHERE nt.technology LIKE '%5G%' AND p.ram_gb >= 12 AND d.price_eur IS NOT NULL
        ORDER BY d.price_eur, brand, model, d.year, ram_gb LIMIT 100""",
    "e04": f"""SELECT dn.brand, COUNT(*) AS device_count, ROUND(AVG(d.price_eur), 2) AS avg_price_eur FROM {N}
        WHERE d.price_eur IS NOT NULL GROUP BY 1 HAVING COUNT(*) >= 5 ORDER BY 3 DESC, 1 LIMIT 100""",
    "e05": """SELECT d.year, COUNT(*) AS device_count, ROUND(AVG(d.battery_capacity_mah)) AS avg_battery_mah FROM Device d
        WHERE d.year >= 2015 AND d.battery_capacity_mah IS NOT NULL GROUP BY 1""",
    "e06": f"""SELECT year, chipset_manufacturer, launches FROM (SELECT d.year, p.chipset_manufacturer, COUNT(*) AS launches,
        ROW_NUMBER() OVER (PARTITION BY d.year ORDER BY COUNT(*) DESC, p.chipset_manufacturer) AS rn
        FROM Device d {P} GROUP BY 1, 2) q WHERE rn = 1""",
    "e07": f"""SELECT dn.brand, dn.model, d.year, d.price_eur FROM {N} WHERE dn.brand = '{B}' AND {PH}
        ORDER BY d.year DESC, dn.model, d.price_eur NULLS LAST LIMIT 5000""",
}
_BRANDED = {"q01", "q16", "q24", "e02", "e07"}

for _name, _sql in SQL.items():
    @query(_name, star_ctes() + _sql)
    def _(i, _name=_name):
        plan = getattr(questions, _name)
        return plan(i.star, brand=B) if _name in _BRANDED else plan(i.star)


@query("adhoc_select", star_ctes() + SQL["q05"])
def _(i):
    i.star.register()
    return adhoc.guarded(i.spark, SQL["q05"] + ";")


@query("adhoc_with_union", star_ctes() + """
    SELECT 'dear' AS label, COUNT(*) AS n FROM Device WHERE price_eur > (SELECT AVG(price_eur) FROM Device)
    UNION SELECT 'priced', COUNT(price_eur) FROM Device""")
def _(i):
    i.star.register()
    return adhoc.guarded(i.spark, """
        WITH a AS (SELECT AVG(price_eur) AS mean FROM Device)
        SELECT 'dear' AS label, COUNT(*) AS n FROM Device WHERE price_eur > (SELECT mean FROM a)
        UNION SELECT 'priced', COUNT(price_eur) FROM Device""")


@query("adhoc_capped", star_ctes() + """
    SELECT true AS truncated, 5000 AS shown""")
def _(i):
    i.star.register()
    rows, truncated = adhoc.with_cap(adhoc.guarded(i.spark, "SELECT id, year FROM Device"), 5000)
    return rows.agg(F.count("*").cast("int").alias("shown")).withColumn("truncated", F.lit(truncated))


_ANSWERS = {
    "q03": SQL["q03"], "q05": SQL["q05"], "q07": SQL["q07"].replace("DESC", "ASC"), "q09": "DROP TABLE Device",
    "q11": "SELECT nothing FROM Device", "q17": "", "q25": SQL["q25"] + " ORDER BY year",
}
_CATEGORY = {"q03": "correct", "q05": "correct", "q07": "wrong-result", "q09": "guard-rejected",
             "q11": "execution-error", "q17": "no-sql", "q25": "correct"}


@query("answer_categories", star_ctes() + " UNION ALL ".join(
    f"SELECT '{k}' AS qid, '{v}' AS category" for k, v in _CATEGORY.items()))
def _(i):
    return adhoc.categorised(_scores(i)).select("qid", "category")


@query("scorecard", f"""SELECT 7 AS n, 5 AS guard_passed, 4 AS executed, 3 AS result_correct, {sig_sql('500.0e0 / 7')} AS guard_passed_pct,
    {sig_sql('400.0e0 / 7')} AS executed_pct, {sig_sql('300.0e0 / 7')} AS result_correct_pct""")
def _(i):
    out = adhoc.scorecard(_scores(i))
    return out.select(*[(sig(F.col(c)) if c.endswith("_pct") else F.col(c).cast("int")).alias(c) for c in out.columns])


_YEARLY = "SELECT year, form_factor, COUNT(*) AS n, MAX(price_eur) AS dearest FROM Device GROUP BY year, form_factor"


@query("adhoc_time_limited", star_ctes() + _YEARLY)
def _(i):
    i.star.register()
    rows, _cut = adhoc.run_readonly(i.spark, _YEARLY, seconds=600)
    return i.spark.createDataFrame(rows, "year int, form_factor string, n long, dearest double")


@query("adhoc_preview", star_ctes(("v", f"SELECT year, form_factor, n, ROW_NUMBER() OVER (ORDER BY year, form_factor) AS pos FROM ({_YEARLY}) q"),
                                  ("l", "SELECT pos, '| ' || year || ' | ' || form_factor || ' | ' || n || ' |' AS line FROM v WHERE pos <= 4")) + """
    SELECT '| year | form_factor | n |' || chr(10) || '|---|---|---|' || chr(10) || string_agg(line, chr(10) ORDER BY pos)
           || chr(10) || chr(10) || '…' || ((SELECT COUNT(*) FROM v) - 4) || ' more row(s) not shown.' || chr(10) || chr(10)
           || '(returned ' || (SELECT COUNT(*) FROM v) || ' row(s))' AS shown FROM l""")
def _(i):
    i.star.register()
    rows = adhoc.guarded(i.spark, f"SELECT year, form_factor, n FROM ({_YEARLY}) ORDER BY year, form_factor")
    return i.spark.createDataFrame([(adhoc.preview(rows, 4),)], "shown string")


def _scores(i):
    i.star.register()
    rows = [adhoc.score_one(i.spark, k, a, SQL[k] + (" ORDER BY year" if k == "q25" else ""), "ordered" if k == "q25" else "set")
            for k, a in _ANSWERS.items()]
    return i.spark.createDataFrame(rows, adhoc.SCORE_SCHEMA)
