"""Filters, joins, top-k, set operations and reshaping (F, J, T, X, R, S01-S06)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import aggregates as agg
from ..operators import filters, joins, ranking, reshape, sets
from ..schemas import STAR_SCHEMAS
from ..session import scratch_path
from ..sources import catalogue, tables
from .inputs import Inputs, raw_ctes, star_ctes
from .registry import query


def _form_counts(df):
    return df.groupBy("form_factor").agg(F.count("*").alias("n"))


@query("filter_form_factor", star_ctes() + "SELECT year, COUNT(*) AS n FROM Device WHERE form_factor = 'tablet' GROUP BY 1")
def _(i):
    return i.star.Device.filter(filters.form_filter("tablet")).groupBy("year").agg(F.count("*").alias("n"))


@query("filter_between", star_ctes() + """
    SELECT form_factor, COUNT(*) AS n FROM Device WHERE year BETWEEN 2019 AND 2022 AND price_eur BETWEEN 100 AND 500.5
    GROUP BY 1""")
def _(i):
    return _form_counts(i.star.Device.filter(
        filters.all_of([filters.between("year", 2019, 2022), filters.between("price_eur", 100, 500.5)])))


@query("filter_not_null", star_ctes() + "SELECT form_factor, COUNT(*) AS n FROM Device WHERE platform_id IS NOT NULL GROUP BY 1")
def _(i):
    return _form_counts(i.star.Device.filter(filters.not_null("platform_id")))


@query("filter_in_list", star_ctes() + """
    SELECT brand, COUNT(*) AS n FROM Device_Name WHERE brand IN ('Brand#3', 'Brand#9', 'it''s') GROUP BY 1""")
def _(i):
    return i.star.Device_Name.filter(filters.in_list("brand", ["Brand#3", "Brand#9", "it's"])).groupBy("brand").agg(
        F.count("*").alias("n"))


@query("filter_like", star_ctes() + """
    SELECT technology, COUNT(*) AS n FROM Network_Technology WHERE technology LIKE '%5G%' GROUP BY 1""")
def _(i):
    return i.star.Network_Technology.filter(filters.contains("technology", "5G")).groupBy("technology").agg(
        F.count("*").alias("n"))


@query("having_min_count", "SELECT l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY 1 HAVING COUNT(*) >= 600")
def _(i):
    return filters.having(i.table("lineitem"), ["l_suppkey"], 600)


@query("complete_cases", star_ctes() + """
    SELECT COUNT(*) AS n, CAST(SUM(battery_capacity_mah) AS BIGINT) AS battery FROM Device
    WHERE price_eur IS NOT NULL AND battery_capacity_mah IS NOT NULL AND weight IS NOT NULL""")
def _(i):
    rows = i.star.Device.withColumn("empty", F.lit(None).cast("double"))
    kept, _dropped = filters.complete_cases(rows, "price_eur", ["battery_capacity_mah", "weight", "empty"])
    return kept.agg(F.count("*").alias("n"), F.sum("battery_capacity_mah").alias("battery"))


@query("drop_all_null_keys", star_ctes() + """
    SELECT COUNT(*) AS n FROM Device WHERE platform_id IS NOT NULL OR camera_id IS NOT NULL OR sim_id IS NOT NULL""")
def _(i):
    return filters.drop_all_null_keys(i.star.Device, ["platform_id", "camera_id", "sim_id"]).agg(F.count("*").alias("n"))


@query("in_subquery", """
    SELECT o_orderpriority, COUNT(*) AS n FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) GROUP BY 1""")
def _(i):
    rich = i.table("customer").filter("c_acctbal > 5000").withColumnRenamed("c_custkey", "o_custkey")
    return filters.in_subquery(i.table("orders"), rich, "o_custkey").groupBy("o_orderpriority").agg(
        F.count("*").alias("n"))


@query("above_average", star_ctes() + """
    SELECT form_factor, COUNT(*) AS n FROM Device WHERE price_eur > (SELECT AVG(price_eur) FROM Device) GROUP BY 1""")
def _(i):
    return _form_counts(filters.compare_to_scalar(i.star.Device, "price_eur", F.avg("price_eur")))


@query("attach_lookup_id", raw_ctes(("dim", """
    SELECT technology, MIN(id) AS id FROM (
      SELECT upper(t) || '  ' AS technology, i AS id
      FROM (SELECT DISTINCT network_technology AS t FROM raw) q,
           (SELECT MIN(part_id) AS i, network_technology AS u FROM raw GROUP BY 2) r WHERE t = u OR (t IS NULL AND u IS NULL)
    ) s GROUP BY 1""")) + """
    SELECT raw.part_id, dim.id AS tech_id FROM raw
    LEFT JOIN dim ON COALESCE(lower(trim(raw.network_technology)), '__missing__')
                   = COALESCE(lower(trim(dim.technology)), '__missing__')""")
def _(i):
    dim = i.raw.groupBy("network_technology").agg(F.min("part_id").alias("id"))
    dim = dim.select(F.concat(F.upper("network_technology"), F.lit("  ")).alias("network_technology"), "id")
    out = joins.attach_lookup_id(i.raw, dim, ["network_technology"], "tech_id")
    return out.select("part_id", "tech_id")


@query("anti_join_new_rows", """
    SELECT p_partkey, p_name FROM part
    WHERE lower(trim(p_name)) NOT IN (SELECT lower(trim(p_name)) FROM part WHERE p_size < 3)""")
def _(i):
    part = i.table("part")
    known = part.filter("p_size < 3").select(F.concat(F.lit(" "), F.upper("p_name")).alias("p_name"))
    return joins.new_rows(part, known, ["p_name"]).select("p_partkey", "p_name")


@query("semi_join_top_groups", star_ctes(("top3", """
    SELECT dn.brand FROM Device d JOIN Device_Name dn ON dn.id = d.device_name_id GROUP BY 1
    ORDER BY COUNT(*) DESC, 1 LIMIT 3""")) + """
    SELECT dn.brand, COUNT(*) AS n FROM Device d JOIN Device_Name dn ON dn.id = d.device_name_id
    WHERE dn.brand IN (SELECT brand FROM top3) GROUP BY 1""")
def _(i):
    rows = joins.join_dim(i.star.Device, i.star.Device_Name, "device_name_id", ["brand"])
    kept = joins.keep_groups(rows, agg.top_groups(rows, "brand", 3), "brand", bounded=True)
    return kept.groupBy("brand").agg(F.count("*").alias("n"))


@query("work_queue", """
    SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)""")
def _(i):
    pages = i.table("pages").select("page_id", "url")
    return joins.work_queue(pages, pages.filter("page_id % 3 = 0")).select("page_id", "url")


@query("work_queue_counts", """
    WITH done AS (SELECT DISTINCT url FROM pages WHERE page_id % 3 = 0)
    SELECT COUNT(*) AS known, COUNT(*) FILTER (WHERE d.url IS NULL) AS queued, COUNT(d.url) AS already_done
    FROM pages p LEFT JOIN done d ON d.url = p.url""")
def _(i):
    pages = i.table("pages").select("page_id", "url")
    return joins.work_queue_counts(pages, pages.filter("page_id % 3 = 0"))


_URLS = """
    SELECT model, url FROM (
      SELECT model, 'https://example.com/' || CAST(part_id AS STRING) AS url,
             ROW_NUMBER() OVER (PARTITION BY model ORDER BY part_id DESC) AS rn
      FROM raw WHERE part_id % 8 <> 0) q WHERE rn = 1"""
_SEEN = """
    SELECT DISTINCT model, CASE WHEN length(model) % 3 = 0 THEN NULL WHEN length(model) % 3 = 1 THEN '2026-05-09T12:00:00Z'
        ELSE 'not a time' END AS scraped_at FROM raw WHERE length(model) % 4 <> 0"""


def _refresh(i: Inputs):
    raw = i.raw
    listed = raw.filter("part_id % 8 <> 0").select(
        "model", F.concat(F.lit("https://example.com/"), F.col("part_id").cast("string")).alias("url"), "part_id")
    urls = reshape.last_wins_index(listed, "model", "url", "part_id")
    size = F.length("model") % 3
    seen = raw.filter(F.length("model") % 4 != 0).select("model").distinct().withColumn(
        "scraped_at", F.when(size == 0, None).when(size == 1, "2026-05-09T12:00:00Z").otherwise("not a time"))
    now = F.lit("2026-05-20 12:00:00").cast("timestamp")
    return raw, urls, seen, now


@query("refresh_states", raw_ctes(("urls", _URLS), ("seen", _SEEN)) + """
    SELECT raw.part_id, raw.model, CASE WHEN u.url IS NULL THEN 'missing_url'
        WHEN s.model IS NOT NULL AND s.scraped_at IS NOT NULL AND s.scraped_at LIKE '2026%'
             AND (TIMESTAMP '2026-05-20 12:00:00' - CAST(replace(replace(s.scraped_at, 'T', ' '), 'Z', '') AS TIMESTAMP))
                 <= INTERVAL 14 DAY THEN 'fresh' ELSE 'queued' END AS state
    FROM raw LEFT JOIN urls u ON u.model = raw.model
    LEFT JOIN (SELECT model, scraped_at FROM seen WHERE scraped_at LIKE '2026%' OR scraped_at IS NULL
               OR scraped_at = 'not a time') s ON s.model = raw.model
    WHERE memory_internal LIKE '%,%'""")
def _(i):
    raw, urls, seen, now = _refresh(i)
    return joins.refresh_states(raw, urls, seen, 14, now, memory="memory_internal").select("part_id", "model", "state")


@query("refresh_queue", raw_ctes(("urls", _URLS), ("seen", _SEEN)) + """
    SELECT raw.model, u.url FROM raw JOIN urls u ON u.model = raw.model
    WHERE memory_internal LIKE '%,%' AND raw.model NOT IN (SELECT model FROM seen)""")
def _(i):
    raw, urls, seen, now = _refresh(i)
    return joins.refresh_queue(raw, urls, seen, None, now, memory="memory_internal")


@query("top_n_by_price", star_ctes() + """
    SELECT form_factor, year, price_eur, battery_capacity_mah FROM Device WHERE price_eur IS NOT NULL
    ORDER BY price_eur DESC, form_factor, year, battery_capacity_mah NULLS LAST LIMIT 20""")
def _(i):
    rows = i.star.Device.select("form_factor", "year", "price_eur", "battery_capacity_mah")
    return ranking.top_n(rows, "price_eur", 20, True,
                         [F.asc("form_factor"), F.asc("year"), F.asc_nulls_last("battery_capacity_mah")])


@query("order_by_many", """
    SELECT p_brand, p_size, p_partkey, ROW_NUMBER() OVER (ORDER BY p_brand DESC, p_size, p_partkey) - 1 AS position FROM part""")
def _(i):
    rows = i.table("part").select("p_brand", "p_size", "p_partkey")
    return sets.with_position(rows.orderBy(F.desc("p_brand"), F.asc("p_size"), F.asc("p_partkey")))


@query("first_per_key", """
    SELECT p_brand, p_type, p_partkey, p_name FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS rn FROM part) q WHERE rn = 1""")
def _(i):
    rows = i.table("part").select("p_brand", "p_type", "p_partkey", "p_name")
    return ranking.first_per_key(rows, ["p_brand", "p_type"], "p_partkey")


@query("hash_sample", """
    SELECT p_partkey, p_brand FROM part ORDER BY md5(CAST(p_partkey AS VARCHAR) || '|7'), p_partkey LIMIT 50""")
def _(i):
    return ranking.hash_sample(i.table("part").select("p_partkey", "p_brand"), 50, ["p_partkey"], seed=7)


@query("hash_sample_per_group", """
    SELECT p_partkey, p_brand FROM (SELECT p_partkey, p_brand, ROW_NUMBER() OVER (PARTITION BY p_brand
      ORDER BY md5(CAST(p_partkey AS VARCHAR) || '|7'), p_partkey) AS rn FROM part) q WHERE rn <= 5""")
def _(i):
    rows = i.table("part").select("p_partkey", "p_brand")
    return ranking.hash_sample(rows, 5, ["p_partkey"], seed=7, per=["p_brand"])


@query("order_statistics", """
    SELECT pos AS position, x AS value FROM (
      SELECT value AS x, ROW_NUMBER() OVER (ORDER BY value) - 1 AS pos FROM events) q WHERE pos % 97 = 0""")
def _(i):
    from ..operators.ordered import every_kth

    return every_kth(i.table("events"), "value", 97)


@query("distinct_rows", "SELECT DISTINCT p_brand, p_type FROM part")
def _(i):
    return sets.distinct(i.table("part").select("p_brand", "p_type"))


@query("distinct_on_subset", """
    SELECT p_brand, MIN(p_partkey) AS p_partkey FROM part GROUP BY 1""")
def _(i):
    return sets.distinct(i.table("part").select("p_brand", "p_partkey"), ["p_brand"], "p_partkey")


@query("union_distinct", """
    SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier""")
def _(i):
    return sets.union_distinct(i.table("customer").select(F.col("c_nationkey").alias("nation")),
                               i.table("supplier").select(F.col("s_nationkey").alias("nation")))


@query("result_difference", """
    WITH a AS (SELECT o_orderpriority AS p, round(o_totalprice, 4) AS v FROM orders),
         b AS (SELECT o_orderpriority AS p, round(o_totalprice + CASE WHEN o_orderkey % 1000 = 0 THEN 1 ELSE 0 END, 4) AS v
               FROM orders),
         u AS (SELECT p, v, 1 AS w FROM a UNION ALL SELECT p, v, -1 FROM b)
    SELECT p, v, CAST(SUM(w) AS BIGINT) AS surplus FROM u GROUP BY 1, 2 HAVING SUM(w) <> 0""")
def _(i):
    a = i.table("orders").select(F.col("o_orderpriority").alias("p"), F.col("o_totalprice").alias("v"), "o_orderkey")
    b = a.withColumn("v", F.col("v") + F.when(F.col("o_orderkey") % 1000 == 0, 1).otherwise(0))
    out = sets.difference(a.drop("o_orderkey"), b.drop("o_orderkey"))
    return out.withColumn("v", F.col("v").cast("double"))


@query("results_equivalent", """
    WITH a AS (SELECT p_partkey AS k, round(p_retailprice, 4) AS v, ROW_NUMBER() OVER (ORDER BY p_partkey) AS up,
                      ROW_NUMBER() OVER (ORDER BY p_partkey DESC) AS down FROM part),
         noisy AS (SELECT p_partkey AS k, round(p_retailprice + 1e-7, 4) AS v, ROW_NUMBER() OVER (ORDER BY p_partkey DESC) AS down FROM part),
         changed AS (SELECT p_partkey AS k, round(p_retailprice + 1, 4) AS v FROM part)
    SELECT NOT EXISTS (SELECT k, v FROM a EXCEPT ALL SELECT k, v FROM noisy) AS shuffled_set,
           NOT EXISTS (SELECT k, v FROM a EXCEPT ALL SELECT k, v FROM changed) AS changed_set,
           NOT EXISTS (SELECT k, v, down FROM a EXCEPT ALL SELECT k, v, down FROM noisy) AS same_order,
           NOT EXISTS (SELECT k, v, up FROM a EXCEPT ALL SELECT k, v, down FROM a) AS other_order""")
def _(i):
    part = i.table("part").select("p_partkey", "p_retailprice")
    up, down = part.orderBy("p_partkey"), part.orderBy(F.desc("p_partkey"))
    noisy = part.withColumn("p_retailprice", F.col("p_retailprice") + 1e-7).orderBy(F.desc("p_partkey"))
    changed = part.withColumn("p_retailprice", F.col("p_retailprice") + 1)
    row = (sets.results_equivalent(up, noisy), sets.results_equivalent(part, changed),
           sets.results_equivalent(down, noisy, "ordered"), sets.results_equivalent(up, down, "ordered"))
    return i.spark.createDataFrame([row], "shuffled_set boolean, changed_set boolean, same_order boolean, other_order boolean")


@query("flatten_columns", "SELECT event_id, event_type AS event_kind, value AS event_detail_value, user_id AS event_detail_user_id FROM events")
def _(i):
    e = i.table("events")
    nested = e.select("event_id", F.struct(
        F.col("event_type").alias("kind"),
        F.struct("value", "user_id").alias("detail")).alias("event"))
    return reshape.flatten_columns(nested)


@query("flatten_json", """
    WITH e AS (SELECT event_id, json_extract_string(props, '$.k') AS k, event_type FROM events)
    SELECT event_id, 'p_k' AS path, k AS value FROM e UNION ALL
    SELECT event_id, 'list_0', event_type FROM e UNION ALL
    SELECT event_id, 'list_1_x', 'true' FROM e UNION ALL
    SELECT event_id, 'gone', NULL FROM e""")
def _(i):
    doc = F.concat(F.lit('{"p": '), "props", F.lit(', "list": ["'), "event_type",
                   F.lit('", {"x": true}], "none": {}, "empty": [], "gone": null}'))
    return reshape.flatten_json(i.table("events").select("event_id", doc.alias("doc")), "doc", ["event_id"])


@query("catalogue_to_rows", """
    SELECT p_brand AS brand, CAST(p_partkey AS VARCHAR) AS model, CAST(p_size AS VARCHAR) AS Body_Size,
           CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS Misc_Type, NULL AS Misc_Absent FROM part""")
def _(i):
    details = F.map_from_arrays(F.array(F.lit("Body"), F.lit("Misc")), F.array(
        F.create_map(F.lit("Size"), F.col("p_size").cast("string")),
        F.when(F.col("p_partkey") % 3 != 0, F.create_map(F.lit("Type"), F.col("p_type")))))
    rows = i.table("part").select(F.col("p_brand").alias("brand"), F.col("p_partkey").cast("string").alias("model"),
                                  details.alias("details"))
    return reshape.fields_to_rows(reshape.catalogue_fields(rows), ["Body_Size", "Misc_Type", "Misc_Absent"])


@query("last_wins_index", """
    SELECT p_name, p_brand FROM (SELECT p_name, p_brand, ROW_NUMBER() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) AS rn
    FROM part) q WHERE rn = 1""")
def _(i):
    return reshape.last_wins_index(i.table("part"), "p_name", "p_brand", "p_partkey")


@query("explode_map", """
    SELECT p_partkey, 'size' AS k, CAST(p_size AS VARCHAR) AS v FROM part WHERE p_partkey % 4 <> 0
    UNION ALL SELECT p_partkey, 'type', p_type FROM part WHERE p_partkey % 4 <> 0""")
def _(i):
    m = F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("type"), F.col("p_type"))
    rows = i.table("part").select("p_partkey", F.when(F.col("p_partkey") % 4 != 0, m).alias("m"))
    return reshape.explode_map(rows, "m", "k", "v")


@query("project_columns", star_ctes() + "SELECT id AS platform, internal_storage_gb AS storage_gb FROM Platform")
def _(i):
    return reshape.project(i.star.Platform, {"platform": "id", "storage_gb": "internal_storage_gb"})


@query("long_values", star_ctes() + """
    SELECT id, 'weight' AS "column", weight AS value FROM Device WHERE weight IS NOT NULL
    UNION ALL SELECT id, 'price_eur', price_eur FROM Device WHERE price_eur IS NOT NULL""")
def _(i):
    return reshape.long_values(i.star.Device, ["weight", "price_eur"], ["id"])


@query("rename_require_drop", "SELECT p_partkey AS id, p_brand AS brand FROM part")
def _(i):
    df = reshape.rename_and_require(i.table("part"), {"p_partkey": "id", "p_brand": "brand"}, ["id", "brand", "p_name"])
    return reshape.drop_required(df, ["p_name", "p_type", "p_size", "p_retailprice"])


@query("roundtrip_csv", """
    SELECT CAST(page_id AS VARCHAR) AS page_id, url, html FROM pages""")
def _(i):
    path = scratch_path(i.spark, "csv")
    df = i.table("pages").select(F.col("page_id").cast("string").alias("page_id"), "url", "html")
    tables.write_table(df, path, "csv")
    return tables.read_csv(i.spark, path, T.StructType([T.StructField(c, T.StringType()) for c in df.columns]))


@query("roundtrip_parquet_append", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation")
def _(i):
    path = scratch_path(i.spark, "append")
    df = i.table("nation").select("n_nationkey", "n_name")
    tables.write_table(df, f"{path}/nation")
    tables.append_table(df, f"{path}/nation")
    return tables.read_table(i.spark, path, "nation")


@query("roundtrip_star", star_ctes() + """
    SELECT form_factor, COUNT(*) AS n, COUNT(price_eur) AS priced, MAX(battery_capacity_mah) AS top_battery
    FROM Device GROUP BY 1""")
def _(i):
    path = scratch_path(i.spark, "star")
    for name in STAR_SCHEMAS:
        tables.write_table(getattr(i.star, name), f"{path}/{name}")
    return tables.read_star(i.spark, path).Device.groupBy("form_factor").agg(
        F.count("*").alias("n"), F.count("price_eur").alias("priced"), F.max("battery_capacity_mah").alias("top_battery"))


@query("catalogue_json_source", """
    SELECT p_brand AS brand, CAST(p_partkey AS VARCHAR) AS model, 'Body' AS section, 'Size' AS field,
           CAST(p_size AS VARCHAR) AS value FROM part
    UNION ALL SELECT p_brand, CAST(p_partkey AS VARCHAR), 'Misc', 'Price', CAST(p_type AS VARCHAR) FROM part""")
def _(i):
    path = scratch_path(i.spark, "catalogue")
    line = F.to_json(F.create_map("p_brand", F.create_map(F.col("p_partkey").cast("string"), F.create_map(
        F.lit("Body"), F.create_map(F.lit("Size"), F.col("p_size").cast("string")),
        F.lit("Misc"), F.create_map(F.lit("Price"), F.col("p_type"))))))
    i.table("part").select(line.alias("value")).write.text(path)
    rows = catalogue.read_catalogue_json(i.spark, path)
    return rows.select("brand", "model", F.explode("details").alias("section", "fields")).select(
        "brand", "model", "section", F.explode("fields").alias("field", "value"))


@query("price_json_source", """
    SELECT CAST(p_partkey AS VARCHAR) AS "Model", '128GB' AS "Configuration", '$ ' || CAST(p_size AS VARCHAR) AS "Price"
    FROM part WHERE p_partkey % 4 IN (0, 1)""")
def _(i):
    path = scratch_path(i.spark, "prices")
    key = F.concat(F.lit('{"'), F.col("p_partkey").cast("string"), F.lit('": '))
    configs = F.concat(F.lit('{"128GB": "$ '), F.col("p_size").cast("string"), F.lit('"}'))
    kind = F.col("p_partkey") % 4
    entry = F.when(kind == 0, F.concat(F.lit('{"scraped_at": "2026-05-09T12:00:00Z", "configs": '), configs, F.lit("}")))
    entry = entry.when(kind == 1, configs).when(kind == 2, "null").otherwise('{"scraped_at": null, "configs": null}')
    i.table("part").select(F.concat(key, entry, F.lit("}")).alias("value")).write.text(path)
    return catalogue.price_rows(catalogue.read_price_json(i.spark, path))
