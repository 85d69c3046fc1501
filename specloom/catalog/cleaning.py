"""Cleaning rules over raw page texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import aggregates as agg
from ..operators import impute, load, quality, reshape
from ..operators.joins import join_dim
from ..plans import clean as plan
from .inputs import raw_ctes, star_ctes
from .registry import query, sig, sig_sql

C = F.col  # short, for the many rules below
# In the checks: a space class that also knows U+2009, and the price number.
SP, NUM = r"[\s\x{2009}]", r"\d{1,3}(?:,\d{3})*\.?\d*"


def rx(col: str, pattern: str, group: int = 1, flags: str = "") -> str:
    """DuckDB: a capture group, NULL where nothing matched."""
    opt = f", '{flags}'" if flags else ""
    return f"NULLIF(regexp_extract({col}, '{pattern}', {group}{opt}), '')"


def dbl(expr: str) -> str:
    return f"TRY_CAST({expr} AS DOUBLE)"


def rule(name: str, columns, check: dict):
    """One query per rule: the part id and the rule's outputs.

    `columns` is a function, since columns need a running session.
    """
    select = ", ".join(f"{expr} AS {out}" for out, expr in check.items())

    @query(name, raw_ctes() + f"SELECT part_id, {select} FROM raw")
    def _(i):
        return i.raw.select("part_id", *[c.alias(out) for out, c in columns().items()])


def _price(symbol: str, code: str | None = None) -> str:
    parts = [rx("misc_price", f"{symbol}{SP}*({NUM})")]
    if code:
        parts.append(rx("misc_price", f"({NUM}){SP}*{code}"))
    return dbl(f"replace(COALESCE({', '.join(parts)}), ',', '')")


EUR, USD, GBP, INR = _price("€", "EUR"), _price(r"\$"), _price("£"), _price("₹", "INR")
rule("clean_price_by_currency", lambda: {k: fn.price_by_currency(C("misc_price"))[k] for k in ("eur", "usd", "gbp", "inr")},
     {"eur": EUR, "usd": USD, "gbp": GBP, "inr": INR})
EURO = f"COALESCE({EUR}, {USD} * 0.93e0, {GBP} * 1.17e0, {INR} * 0.011e0)"
rule("clean_price_eur", lambda: {"price": fn.price_eur(C("misc_price"))}, {"price": EURO})

N = r"(\d+(?:\.\d+)?)"
_three, _unk = rf"{N}\s*x\s*{N}\s*x\s*{N}\s*mm", rf"{N}\s*x\s*(?:unknown|x\.x|-)\s*x\s*{N}\s*mm"
_two, _thick, _label, _cc = rf"{N}\s*x\s*{N}\s*mm\b", rf"{N}\s*mm\s*thick", rf"thickness[^0-9]*{N}\s*mm", rf"{N}\s*cc\b"


def _dim(axis: str) -> str:
    b = "body_dimensions"
    g = lambda p, n: dbl(rx(b, p, n, "i"))
    picks = {
        "length": {_three: g(_three, 1), _unk: g(_unk, 1), _two: g(_two, 1)},
        "width": {_three: g(_three, 2), _two: g(_two, 2)},
        "height": {_three: g(_three, 3), _unk: g(_unk, 2), _thick: g(_thick, 1), _label: g(_label, 1)},
        "volume": {_three: f"{g(_three, 1)} * {g(_three, 2)} * {g(_three, 3)}", _cc: g(_cc, 1)},
    }[axis]
    whens = " ".join(f"WHEN regexp_matches({b}, '{p}', 'i') THEN {picks.get(p, 'NULL')}"
                     for p in (_three, _unk, _two, _thick, _label, _cc))
    return f"CASE {whens} END"


AXES = ("length", "width", "height", "volume")
rule("clean_dimensions", lambda: {a: fn.dimensions(C("body_dimensions"))[a] for a in AXES}, {a: _dim(a) for a in AXES})
rule("clean_weight", lambda: {"weight": fn.weight_g(C("body_weight"))}, {"weight": dbl(rx("body_weight", N))})
rule("clean_network_flags", lambda: {f"has_{g}": fn.network_flag(C(f"network_{g}_bands")) for g in ("2g", "3g", "4g", "5g")},
     {f"has_{g}": f"CAST(network_{g}_bands IS NOT NULL AS INT)" for g in ("2g", "3g", "4g", "5g")})
MAH = f"CAST(round_even({dbl(f'''replace({rx('battery_type', r'(\d[\d,]*(?:\.\d+)?)\s*mAh', 1, 'i')}, ',', '')''')}, 0) AS INT)"
rule("clean_battery", lambda: {"mah": fn.battery_mah(C("battery_type"))}, {"mah": MAH})
rule("clean_sensors", lambda: {"parts": F.concat_ws("#", fn.split_list(C("features_sensors"))), "n": F.size(fn.split_list(C("features_sensors")))},
     {"parts": "COALESCE(replace(features_sensors, ',', '#'), '')",
      "n": "CASE WHEN features_sensors IS NULL THEN NULL ELSE length(features_sensors) - length(replace(features_sensors, ',', '')) + 1 END"})
SIZE = {"inch": dbl(rx("display_size", r"(\d+\.?\d*) inches")), "cm2": dbl(rx("display_size", r"(\d+\.?\d*) cm2")),
        "screen_to_body": dbl(rx("display_size", r"~(\d+\.?\d*)%"))}
rule("clean_display_size", lambda: {k: fn.display_size(C("display_size"))[k] for k in SIZE}, SIZE)
RES = {"pixels": rx("display_resolution", r"(\d+ x \d+) pixels"),
       "ratio": rx("display_resolution", r"(\d+(?:\.\d+)?:\d+) ratio"),
       "ppi": dbl(rx("display_resolution", r"~?(\d+) ppi"))}
rule("clean_resolution", lambda: {k: fn.resolution(C("display_resolution"))[k] for k in RES}, RES)
COUNT_PX = (f"COALESCE(CAST(split_part({RES['pixels']}, ' x ', 1) AS BIGINT) * "
            f"CAST(split_part({RES['pixels']}, ' x ', 2) AS BIGINT), 0)")
rule("clean_pixel_count", lambda: {"pixels": fn.pixel_count(fn.resolution(C("display_resolution"))["pixels"])}, {"pixels": COUNT_PX})
_sim = "lower(trim(body_sim))"
SIM_TYPE = (f"CASE WHEN body_sim IS NULL THEN NULL WHEN {_sim} IN ('no', 'none', '-') THEN 'none' " +
            " ".join(f"WHEN {_sim} LIKE '%{k}%' THEN '{k}'" for k in ("nano", "micro", "mini", "esim")) + " ELSE 'unknown' END")
SIM_COUNT = (f"CASE WHEN body_sim IS NULL THEN NULL WHEN {_sim} IN ('no', 'none', '-') THEN 'none' " +
             " ".join(f"WHEN {_sim} LIKE '%{k}%' THEN '{k}'" for k in ("triple", "dual", "single")) +
             f" WHEN {_sim} LIKE '%sim%' OR {_sim} = 'yes' THEN 'single' ELSE 'none' END")
rule("clean_sim_type", lambda: {"sim_type": fn.sim_type(C("body_sim"))}, {"sim_type": SIM_TYPE})
rule("clean_sim_count", lambda: {"sim_count": fn.sim_count(C("body_sim"))}, {"sim_count": SIM_COUNT})
_os = "trim(platform_os)"
BASE_OS = (f"CASE WHEN regexp_matches({_os}, '^Wear OS($|[ ,])') THEN 'Wear OS' "
           f"WHEN regexp_matches({_os}, '^Blue OS($|[ ,])') THEN 'Blue OS' "
           f"WHEN regexp_matches({_os}, '^Firefox OS($|[ ,])') THEN 'Firefox OS' "
           f"ELSE CASE rtrim(split_part({_os}, ' ', 1), ',.;:') WHEN 'Harmony' THEN 'HarmonyOS' "
           f"WHEN 'Android-based' THEN 'Android' WHEN 'Symbian^3' THEN 'Symbian' WHEN 'Firefox' THEN 'Firefox OS' "
           f"ELSE rtrim(split_part({_os}, ' ', 1), ',.;:') END END")
rule("clean_base_os", lambda: {"base_os": fn.base_os(C("platform_os"))}, {"base_os": BASE_OS})
OS_VERSION = rx("platform_os", r"\b(\d+(?:\.\d+)*)\b")
rule("clean_os_version", lambda: {"os_version": fn.os_version(C("platform_os"))}, {"os_version": OS_VERSION})
BRAND = "CASE brand WHEN 'alcatel' THEN 'Alcatel' ELSE brand END"
rule("clean_brand", lambda: {"brand": fn.canonical(C("brand"), fn.BRAND_SPELLING)}, {"brand": BRAND})
MAKER = ("CASE " + " ".join(f"WHEN platform_chipset LIKE '%{m}%' THEN '{m}'" for m in (
    "Qualcomm", "Mediatek", "Apple", "Samsung", "Exynos", "Intel Atom")) + " ELSE 'Other' END")
rule("clean_chipset", lambda: {"maker": fn.chipset_maker(C("platform_chipset"))}, {"maker": MAKER})
CORES = ("CASE WHEN platform_cpu IS NULL OR trim(platform_cpu) = '' THEN NULL " + " ".join(
    f"WHEN platform_cpu ILIKE '%{w}-core%' THEN {n}" for w, n in (("dual", 2), ("quad", 4), ("hexa", 6), ("octa", 8), ("deca", 10))
) + " ELSE 1 END")
rule("clean_cpu_cores", lambda: {"cores": fn.cpu_cores(C("platform_cpu"))}, {"cores": CORES})
_slot = "lower(memory_card_slot)"
SLOT = (f"CASE WHEN memory_card_slot IS NULL THEN NULL WHEN {_slot} LIKE '%no%' THEN 'No' WHEN {_slot} LIKE '%microsd%' "
        f"THEN 'Microsd' WHEN {_slot} LIKE '%sd%' THEN 'Sd' WHEN {_slot} LIKE '%mmc%' THEN 'Mmc' "
        f"WHEN {_slot} LIKE '%yes%' THEN 'Yes' ELSE 'Unknown' END")
rule("clean_card_slot", lambda: {"slot": fn.card_slot(C("memory_card_slot"))}, {"slot": SLOT})
_ls = "lower(trim(launch_status))"
STATUS = (f"CASE WHEN {_ls} LIKE 'available%' THEN 'Available' WHEN {_ls} LIKE '%discontinued%' THEN 'Discontinued' "
          f"WHEN {_ls} LIKE '%cancel%' THEN 'Canceled' WHEN {_ls} LIKE '%rumor%' OR {_ls} LIKE '%coming%' THEN 'Rumored' END")
rule("clean_launch_status", lambda: {"status": fn.launch_status(C("launch_status"))}, {"status": STATUS})

# One row per memory piece, as DuckDB unnests it; only the shapes that the texts have.
_Q = r"\d+\.?\d*\s*[GTMB]B"
_GENERAL = rf"({_Q})(?:\s*\({_Q}\s*user available\))?(?:/\s*{_Q}\s*\([^)]+\))?,?\s*({_Q})\s*RAM"
STORAGE = f"COALESCE({rx('piece', _GENERAL, 1)}, {rx('piece', rf'^({_Q})$')})"
RAM = f"COALESCE({rx('piece', _GENERAL, 2)}, {rx('piece', r'^(\d+\.?\d*\s*[GM]B)\s*RAM$')})"
PIECES = ("pieces", "SELECT *, trim(unnest(regexp_split_to_array(memory_internal, '[,;]'))) AS piece FROM raw")


@query("clean_storage_and_ram", raw_ctes(PIECES) + f"""
    SELECT part_id, piece, {STORAGE} AS storage, {RAM} AS ram FROM pieces""")
def _(i):
    pieces = i.raw.select("part_id", F.explode(F.split("memory_internal", "[,;]")).alias("piece"))
    pieces = pieces.withColumn("piece", fn.strip(C("piece")))
    both = fn.storage_and_ram(C("piece"))
    return pieces.select("part_id", "piece", both["storage"].alias("storage"), both["ram"].alias("ram"))


def _gb(expr: str) -> str:
    q, u = dbl(rx(expr, r"(\d+(?:\.\d+)?)\s*(TB|GB|MB)\b", 1, "i")), f"upper({rx(expr, r'(\d+(?:\.\d+)?)\s*(TB|GB|MB)\b', 2, 'i')})"
    gb = f"(CASE {u} WHEN 'TB' THEN {q} * 1024 WHEN 'GB' THEN {q} WHEN 'MB' THEN {q} / 1024 END)"
    return f"CASE WHEN {gb} <= 0 THEN NULL WHEN {gb} < 1 THEN 1 ELSE CAST(round_even({gb}, 0) AS INT) END"


rule("clean_memory_gb", lambda: {"gb": fn.memory_gb(C("memory_internal"))}, {"gb": _gb("memory_internal")})
rule("clean_storage_tiers", lambda: {"tiers": fn.storage_tiers(C("memory_internal"))}, {
    "tiers": r"COALESCE(len(list_filter(string_split(memory_internal, ','), lambda x: "
             r"regexp_matches(x, '(?i)\b\d+\s*(?:GB|TB|MB)\s*'))), 0)"})
rule("clean_launch_year", lambda: {"year": fn.launch_year(C("launch_announced"))},
     {"year": "CASE WHEN launch_announced <> 'Not announced yet' THEN " +
              f"TRY_CAST({rx('launch_announced', r'(\d{4})')} AS INT) END"})
rule("clean_form_factor", lambda: {"form": fn.form_factor(C("model"))}, {
    "form": "CASE WHEN model IS NULL THEN 'other' WHEN model ILIKE '%watch%' OR model ILIKE '%gear %' OR model ILIKE '%fitbit%' "
            "THEN 'watch' WHEN model ILIKE '%tab %' OR model ILIKE '%ipad%' OR model ILIKE '%matepad%' OR model ILIKE '%mediapad%' "
            "OR model ILIKE '%mipad%' OR model ILIKE '%mi pad%' THEN 'tablet' WHEN model ILIKE '%band%' THEN 'band' ELSE 'phone' END"})
_item = r"""'([^']*)'"""
_strip = r"""regexp_replace(regexp_replace(trim(x), '^[''"]+|[''"]+$', '', 'g'), '\s+', ' ', 'g')"""


def _sensor_sql() -> str:
    literal = r"""regexp_matches(trim(features_sensors), '^\[\s*''')"""
    parts = (f"CASE WHEN {literal} THEN regexp_extract_all(features_sensors, '''([^'']*)''', 1) "
             f"ELSE string_split(trim(trim(features_sensors), '[]'), ',') END")
    cleaned = f"list_transform({parts}, lambda x: lower(trim({_strip})))"
    kept = f"list_filter({cleaned}, lambda x: x <> '' AND x <> 'nan')"
    first = f"list_filter({kept}, lambda x, n: list_position({kept}, x) = n)"
    return f"COALESCE(array_to_string({first}, '#'), '')"


rule("clean_sensor_list", lambda: {"sensors": F.concat_ws("#", fn.sensor_list(C("features_sensors")))}, {"sensors": _sensor_sql()})


@query("clean_first_number", r"""
    SELECT doc_id, TRY_CAST(NULLIF(regexp_extract(text, '-?\d+(\.\d+)?', 0), '') AS DOUBLE) AS num,
           CAST(trunc(TRY_CAST(NULLIF(regexp_extract(text, '-?\d+(\.\d+)?', 0), '') AS DOUBLE)) AS BIGINT) AS whole
    FROM documents""")
def _(i):
    return i.table("documents").select("doc_id", fn.first_number(C("text")).alias("num"), fn.first_int(C("text")).alias("whole"))


@query("clean_max_number", r"""
    SELECT doc_id, list_max(list_transform(regexp_extract_all(text, '-?\d+(?:\.\d+)?'), lambda x: TRY_CAST(x AS DOUBLE))) AS top
    FROM documents""")
def _(i):
    return i.table("documents").select("doc_id", fn.max_number(C("text")).alias("top"))


@query("clean_text", r"""
    SELECT conv_id, turn, role, NULLIF(trim(regexp_replace(text, '\s+', ' ', 'g')), '') AS text,
           lower(trim(regexp_replace(role || '  x', '\s+', ' ', 'g'))) AS low FROM conversations""")
def _(i):
    return i.table("conversations").select(
        "conv_id", "turn", "role", fn.clean_text(C("text")).alias("text"),
        fn.clean_text(F.concat("role", F.lit("  x")), lowercase=True).alias("low"))


@query("lookup_key", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS price,
           CASE WHEN l_extendedprice = floor(l_extendedprice) THEN CAST(CAST(l_extendedprice AS BIGINT) AS VARCHAR)
                ELSE printf('%g', l_extendedprice) END AS price_key,
           CASE WHEN l_tax = floor(l_tax) THEN CAST(CAST(l_tax AS BIGINT) AS VARCHAR)
                ELSE printf('%g', l_tax / 700000) END AS small_key,
           CASE WHEN l_linenumber = 5 THEN '__missing__' ELSE lower(l_returnflag) END AS text_key,
           CAST(l_partkey AS VARCHAR) AS int_key FROM lineitem""")
def _(i):
    odd = F.when(C("l_linenumber") == 5, None).otherwise(F.concat(F.lit(" "), "l_returnflag", F.lit(" ")))
    small = F.when(C("l_tax") == F.floor("l_tax"), C("l_tax")).otherwise(C("l_tax") / 700000)
    return i.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", C("l_extendedprice").alias("price"),
        fn.lookup_key(C("l_extendedprice"), "double").alias("price_key"), fn.lookup_key(small, "double").alias("small_key"),
        fn.lookup_key(odd, "string").alias("text_key"), fn.lookup_key(C("l_partkey"), "bigint").alias("int_key"))


@query("row_signature", star_ctes() + """
    SELECT id, year, price_eur, sha256(concat(CAST(year AS VARCHAR), '|', CASE WHEN price_eur IS NULL THEN '__missing__'
        WHEN price_eur = floor(price_eur) THEN CAST(CAST(price_eur AS BIGINT) AS VARCHAR) ELSE printf('%g', price_eur) END,
        '|', COALESCE(lower(launch_status), '__missing__'))) AS signature FROM Device""")
def _(i):
    d = i.star.Device
    return d.select("id", "year", "price_eur", fn.row_signature(d, ["year", "price_eur", "launch_status"]).alias("signature"))


MAIN = "COALESCE(main_camera_single, main_camera_dual, main_camera_triple, main_camera_quad, main_camera_dual_or_triple, main_camera_penta, main_camera_five)"
SELFIE = "COALESCE(selfie_camera_single, selfie_camera_dual, selfie_camera_triple)"


def _mp(expr: str) -> str:
    legacy = "greatest(" + ", ".join(
        rf"CASE WHEN regexp_matches(lower({expr}), '\b{k}\b') THEN {v}e0 END" for k, v in
        (("qcif", 0.025), ("qvga", 0.077), ("cif", 0.101), ("vga", 0.307), ("svga", 0.48))) + ")"
    top = rf"list_max(list_transform(regexp_extract_all({expr}, '(\d+(?:\.\d+)?)\s*MP', 1), lambda x: CAST(x AS DOUBLE)))"
    return f"COALESCE(CAST({top} AS VARCHAR), CAST({legacy} AS VARCHAR), {expr})"


_main = [f"main_camera_{k}" for k in ("single", "dual", "triple", "quad", "dual_or_triple", "penta", "five")]
_selfie = [f"selfie_camera_{k}" for k in ("single", "dual", "triple")]
rule("first_non_null", lambda: {"spec": fn.first_non_null(*map(C, _main)), "selfie": fn.first_non_null(*map(C, _selfie))}, {"spec": MAIN, "selfie": SELFIE})
_counts = {"single": 1, "dual": 2, "triple": 3, "quad": 4, "dual_or_triple": 3, "penta": 5, "five": 5}
CAMERAS = "CASE " + " ".join(f"WHEN main_camera_{k} IS NOT NULL THEN {n}" for k, n in reversed(_counts.items())) + " ELSE 0 END"
SELFIES = "CASE WHEN selfie_camera_triple IS NOT NULL THEN 3 WHEN selfie_camera_dual IS NOT NULL THEN 2 " \
          "WHEN selfie_camera_single IS NOT NULL THEN 1 ELSE 0 END"
rule("count_from_populated", lambda: {"cameras": fn.count_from_populated({f"main_camera_{k}": n for k, n in _counts.items()})}, {"cameras": CAMERAS})
rule("clean_highest_mp", lambda: {"main": fn.highest_mp(fn.first_non_null(*map(C, _main))), "selfie": fn.highest_mp(fn.first_non_null(*map(C, _selfie)))},
     {"main": _mp(MAIN), "selfie": _mp(SELFIE)})
rule("clean_video_res", lambda: {"res": fn.video_res(C("main_camera_video")), "selfie": fn.video_res(C("selfie_camera_video"))},
     {c: f"CASE WHEN {e} LIKE '%@%' THEN trim(split_part({e}, '@', 1)) ELSE {e} END"
      for c, e in (("res", "main_camera_video"), ("selfie", "selfie_camera_video"))})
rule("clean_features", lambda: {"first": F.get(fn.split_list(C("main_camera_features")), F.lit(0)), "n": F.size(fn.split_list(C("main_camera_features")))},
     {"first": "CASE WHEN main_camera_features IS NULL THEN NULL ELSE split_part(main_camera_features, ',', 1) END",
      "n": "CASE WHEN main_camera_features IS NULL THEN NULL ELSE len(string_split(main_camera_features, ',')) END"})
rule("clean_size_class", lambda: {"size": fn.size_class(fn.display_size(C("display_size"))["inch"])}, {"size": f"CASE WHEN {SIZE['inch']} >= 7 THEN 'large' ELSE 'small' END"})
rule("network_generations", lambda: {f"is_{g.lower()}": c for g, c in fn.network_generations(C("network_technology")).items()}, {
    "is_2g": "contains(network_technology, 'GSM') OR contains(network_technology, 'CDMA')",
    "is_3g": "contains(network_technology, 'HSPA') OR contains(network_technology, 'EVDO') OR contains(network_technology, 'CDMA2000')",
    "is_4g": "contains(network_technology, 'LTE')", "is_5g": "contains(network_technology, '5G')"})
rule("is_sentinel", lambda: {"text": fn.is_sentinel(F.when(C("part_id") % 4 == 0, " Unknown ").when(C("part_id") % 4 == 1, "NaN").otherwise(C("body_weight")))},
     {"text": "CASE WHEN part_id % 4 IN (0, 1) THEN true ELSE body_weight IS NULL END"})


@query("comparable_values", """
    SELECT o_orderkey, CAST(CAST(round_even(o_totalprice / 7, 4) AS DOUBLE) AS VARCHAR) AS a, o_orderpriority AS b,
           CAST(CAST(o_custkey AS DOUBLE) AS VARCHAR) AS c FROM orders""")
def _(i):
    out = i.table("orders").select(
        "o_orderkey", fn.comparable(C("o_totalprice") / 7, "double").alias("a"), fn.comparable(C("o_orderpriority"), "string").alias("b"),
        fn.comparable(C("o_custkey").cast("string"), "string").alias("c"))
    return out


@query("is_stale", """
    SELECT event_id, CASE WHEN event_id % 5 = 0 THEN true ELSE TIMESTAMP '2024-02-01 00:00:00' - date_trunc('second', ts)
        > INTERVAL 25 DAY END AS stale FROM events""")
def _(i):
    stamp = F.when(C("event_id") % 10 == 0, None).when(C("event_id") % 10 == 5, "soon").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return i.table("events").select("event_id", fn.is_stale(stamp, 25, now).alias("stale"))


EXPANDED = ("expanded", f"SELECT * FROM (SELECT *, {STORAGE} AS storage, {RAM} AS ram FROM pieces) q "
                        "WHERE storage IS NOT NULL AND ram IS NOT NULL")
LISTED = ("listed", """SELECT model AS m, configuration, price FROM (SELECT *, ROW_NUMBER() OVER (
    PARTITION BY model, configuration ORDER BY seq DESC) AS rn FROM prices) q WHERE rn = 1""")
PRICED = ("repriced", """SELECT e.* REPLACE (COALESCE(l.price, e.misc_price) AS misc_price) FROM expanded e LEFT JOIN listed l
    ON l.m = e.model AND l.configuration = e.storage || ' ' || e.ram || ' RAM'""")


@query("expand_configs", raw_ctes(PIECES, EXPANDED) + 'SELECT part_id, storage AS "Storage", ram AS "RAM" FROM expanded')
def _(i):
    return reshape.expand_configs(i.raw, "memory_internal").select("part_id", "Storage", "RAM")


@query("override_price", raw_ctes(PIECES, EXPANDED, LISTED, PRICED) + """
    SELECT part_id, storage AS "Storage", ram AS "RAM", misc_price FROM repriced""")
def _(i):
    rows = reshape.expand_configs(i.raw, "memory_internal")
    return reshape.override_price(rows, i.prices, "misc_price", ordinal="seq").select("part_id", "Storage", "RAM", "misc_price")


@query("miss_counts", raw_ctes() + f"""
    SELECT COUNT(*) FILTER (WHERE battery_type IS NULL) AS empty,
           COUNT(*) FILTER (WHERE battery_type IS NOT NULL AND {MAH} IS NULL) AS unparseable FROM raw""")
def _(i):
    return agg.miss_counts(i.raw, C("battery_type"), fn.battery_mah(C("battery_type")))


@query("dimension_states", raw_ctes() + f"""
    SELECT CASE WHEN body_dimensions IS NULL OR trim(body_dimensions) IN ('', '-') THEN 'missing'
        WHEN COALESCE({_dim('length')}, {_dim('height')}, {_dim('volume')}) IS NULL THEN 'unparseable' ELSE 'ok' END AS label,
        COUNT(*) AS n FROM raw GROUP BY 1""")
def _(i):
    return agg.label_counts(i.raw, fn.dimensions_state(C("body_dimensions")))


@query("currency_counts", raw_ctes() + f"""
    SELECT CASE WHEN misc_price IS NULL THEN 'missing' WHEN {EUR} IS NOT NULL THEN 'EUR-native' WHEN {USD} IS NOT NULL
        THEN 'from USD' WHEN {GBP} IS NOT NULL THEN 'from GBP' WHEN {INR} IS NOT NULL THEN 'from INR' ELSE 'unrecognised' END
        AS label, COUNT(*) AS n FROM raw GROUP BY 1""")
def _(i):
    return agg.label_counts(i.raw, fn.price_source(C("misc_price")))


@query("audit_counts", raw_ctes() + f"""
    SELECT 'Battery_capacity' AS col, COUNT(*) AS row_count, COUNT(battery_type) AS raw_present,
           COUNT(*) FILTER (WHERE battery_type IS NOT NULL AND {MAH} IS NULL) AS fall_through FROM raw
    UNION ALL SELECT 'base_os', COUNT(*), COUNT(platform_os),
           COUNT(*) FILTER (WHERE platform_os IS NOT NULL AND lower({BASE_OS}) IN ('', 'nan', 'unknown', 'none')) FROM raw
    UNION ALL SELECT 'Highest_maincam_res', COUNT(*), COUNT({MAIN}), 0 FROM raw
    UNION ALL SELECT 'SIM_type', COUNT(*), COUNT(body_sim), COUNT(*) FILTER (WHERE {SIM_TYPE} IN ('none', 'unknown')) FROM raw""")
def _(i):
    frame = plan.audit_frame(i.raw_pages)
    out = None
    for col in ("Battery_capacity", "base_os", "Highest_maincam_res", "SIM_type"):
        one = quality.fallthrough_counts(frame, plan.AUDITED[col], col).withColumn("col", F.lit(col))
        out = one if out is None else out.unionByName(one)
    return out


@query("audit_values", raw_ctes() + f"""
    SELECT body_dimensions AS raw, COUNT(*) AS n FROM raw WHERE body_dimensions IS NOT NULL AND {_dim('height')} IS NULL
    GROUP BY 1 ORDER BY n DESC, raw LIMIT 20""")
def _(i):
    return quality.fallthrough_values(plan.audit_frame(i.raw_pages), ["Body_Dimensions"], "height")


def _spaced(c: str) -> str:
    return c.replace(" ", "_").lower()


# Every audited column in SQL: what its raw text comes to.
_AUDIT = {
    "Number of main cameras": CAMERAS, "Number of selfie cameras": SELFIES, "Highest_maincam_res": _mp(MAIN),
    "Highest_selfiecam_res": _mp(SELFIE), **{a: _dim(a) for a in AXES}, "weight": dbl(rx("body_weight", N)), "Battery_capacity": MAH,
    "SIM_type": SIM_TYPE, "SIM_count": SIM_COUNT, "Display_Size_Inch": SIZE["inch"], "Display_Size_Cm": SIZE["cm2"],
    "Screen_To_Body_Ratio": SIZE["screen_to_body"], "Resolution_Pixels": RES["pixels"], "Resolution_Ratio": RES["ratio"],
    "PPI_Density": RES["ppi"], "base_os": BASE_OS, "OS_Version": OS_VERSION, "Chipset_Manufacturer": MAKER, "CPU_Core_Count": CORES,
    "Sensors": "features_sensors",
}
_NUMBERS = {*AXES, "weight", "Battery_capacity", "Display_Size_Inch", "Display_Size_Cm", "Screen_To_Body_Ratio", "PPI_Density",
            "CPU_Core_Count", "Number of main cameras", "Number of selfie cameras", "Sensors"}


def _audited(c: str) -> tuple[str, str, str]:
    """Raw text there, raw text that came to nothing, and the text, in SQL."""
    raw = [_spaced(r) for r in plan.AUDITED[c]]
    there = "(" + " OR ".join(f"{r} IS NOT NULL" for r in raw) + ")"
    gone = f"v IS NULL{'' if c in _NUMBERS else " OR lower(trim(v)) IN ('', 'nan', 'unknown', 'none')"}"
    return there, f"({there} AND ({gone}))", " || ' | ' || ".join(f"COALESCE({r}, '')" for r in raw)


@query("audit_all_counts", raw_ctes() + " UNION ALL ".join(
    f"SELECT '{c}' AS col, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE {_audited(c)[0]}) AS raw_present, "
    f"COUNT(*) FILTER (WHERE {_audited(c)[1]}) AS fall_through FROM (SELECT *, {e} AS v FROM raw) q" for c, e in _AUDIT.items()))
def _(i):
    return plan.audit_all(i.raw_pages).counts


@query("audit_all_values", raw_ctes() + " UNION ALL ".join(
    f"(SELECT '{c}' AS col, {_audited(c)[2]} AS raw, COUNT(*) AS n FROM (SELECT *, {e} AS v FROM raw) q WHERE {_audited(c)[1]} "
    f"GROUP BY 2 ORDER BY n DESC, raw LIMIT 20)" for c, e in _AUDIT.items()))
def _(i):
    return plan.audit_all(i.raw_pages).values


@query("audit_flags", raw_ctes() + " UNION ALL ".join(
    f"SELECT '{g}' AS col, {v} AS value, COUNT(*) FILTER (WHERE network_{g.lower()}_bands IS {'NOT ' if v else ''}NULL) AS n FROM raw"
    for g in plan.FLAGS for v in (0, 1)))
def _(i):
    return plan.audit_all(i.raw_pages).flags


_CLEANED = {
    "cameras": CAMERAS, "selfies": SELFIES, "main_mp": _mp(MAIN), "weight": dbl(rx("body_weight", N)), "length": _dim("length"),
    "volume": _dim("volume"), "mah": MAH, "sim_type": SIM_TYPE, "sim_count": SIM_COUNT, "inch": SIZE["inch"],
    "base_os": BASE_OS, "os_version": OS_VERSION, "maker": MAKER, "cores": CORES,
}
_NAMES = {
    "Number of main cameras": "cameras", "Number of selfie cameras": "selfies", "Highest_maincam_res": "main_mp",
    "weight": "weight", "length": "length", "volume": "volume", "Battery_capacity": "mah", "SIM_type": "sim_type",
    "SIM_count": "sim_count", "Display_Size_Inch": "inch", "base_os": "base_os", "OS_Version": "os_version",
    "Chipset_Manufacturer": "maker", "CPU_Core_Count": "cores",
}
_SELECT = ", ".join(f"{e} AS {n}" for n, e in _CLEANED.items())


@query("audit_frame", raw_ctes() + f"SELECT part_id, {_SELECT} FROM raw")
def _(i):
    return plan.audit_frame(i.raw_pages).select("part_id", *[C(f"`{c}`").alias(n) for c, n in _NAMES.items()])


YEAR = "CASE WHEN launch_announced <> 'Not announced yet' THEN " + f"TRY_CAST({rx('launch_announced', r'(\d{4})')} AS INT) END"
CHAIN = ("chain", f"""SELECT part_id, {BRAND} AS brand, model, {YEAR} AS year, storage, ram, {EURO} AS price,
    {STATUS} AS status, {COUNT_PX} AS pixels, {_SELECT} FROM repriced WHERE {YEAR} > 2010""")
_FILL = [
    ("priced", "SELECT * FROM {src} WHERE price IS NOT NULL"),
    ("m", "SELECT model AS k, AVG(price) AS v FROM priced GROUP BY 1"),
    ("by", "SELECT brand AS k, year AS y, median(price) AS v FROM priced GROUP BY 1, 2 HAVING COUNT(*) >= 3"),
    ("b", "SELECT brand AS k, median(price) AS v FROM priced GROUP BY 1 HAVING COUNT(*) >= 5"),
]


def _fill(src: str):
    return [(n, q.format(src=src)) for n, q in _FILL]


_JOINED = """ c LEFT JOIN m ON m.k = c.model LEFT JOIN "by" ON "by".k = c.brand AND "by".y = c.year
    LEFT JOIN b ON b.k = c.brand"""
_FILLED = 'COALESCE(c.price, m.v, "by".v, b.v)'
_SOURCE = """CASE WHEN c.price IS NOT NULL THEN 'original' WHEN m.v IS NOT NULL THEN 'within_model'
    WHEN "by".v IS NOT NULL THEN 'brand_year' WHEN b.v IS NOT NULL THEN 'brand_only' ELSE 'still_missing' END"""


@query("clean_chain", raw_ctes(PIECES, EXPANDED, LISTED, PRICED, CHAIN, *[(f'"{n}"', q) for n, q in _fill("chain")]) + f"""
    SELECT part_id, c.brand, model, c.year, storage, ram, {sig_sql(_FILLED, 12)} AS price, status, pixels,
           {", ".join(_CLEANED)} FROM chain{_JOINED}""")
def _(i):
    rows = plan.clean(i.raw_pages, i.prices)
    return rows.select(
        "part_id", "brand", "model", "year", C("Storage").alias("storage"), C("RAM").alias("ram"),
        sig(C("Price_EUR"), 12).alias("price"), C("Launch_Status").alias("status"), C("Resolution_Pixels").alias("pixels"),
        *[C(f"`{c}`").alias(n) for c, n in _NAMES.items()])


# Imputation on the large table: models of brands, with some brands left without prices.
_GAPS = ("g", """SELECT d.id, dn.brand, dn.brand || '/' || CAST(d.device_name_id AS VARCHAR) AS model, d.year,
    CASE WHEN d.device_name_id % 3 = 0 OR (dn.brand = 'Brand#4' AND d.year < 2024) OR dn.brand = 'Brand#5' THEN NULL
         ELSE d.price_eur END AS price FROM Device d JOIN Device_Name dn ON dn.id = d.device_name_id""")


def _gaps(i):
    rows = join_dim(i.star.Device, i.star.Device_Name, "device_name_id", ["brand"])
    gone = (C("device_name_id") % 3 == 0) | ((C("brand") == "Brand#4") & (C("year") < 2024)) | (C("brand") == "Brand#5")
    return rows.select(
        "id", "brand", F.concat("brand", F.lit("/"), C("device_name_id").cast("string")).alias("model"), "year",
        F.when(~gone, C("price_eur")).alias("price"))


@query("impute_cascade", star_ctes(_GAPS, *[(f'"{n}"', q) for n, q in _fill("g")]) + f"""
    SELECT c.id, c.model, {sig_sql(_FILLED, 12)} AS price FROM g{_JOINED}""")
def _(i):
    return impute.impute_cascade(_gaps(i), value="price").select("id", "model", sig(C("price"), 12).alias("price"))


@query("impute_counts", star_ctes(_GAPS, *[(f'"{n}"', q) for n, q in _fill("g")]) + f"""
    SELECT {_SOURCE} AS fill_source, COUNT(*) AS n FROM g{_JOINED} WHERE c.price IS NULL GROUP BY 1""")
def _(i):
    return impute.impute_counts(_gaps(i), value="price")


STAGED = ("staged", f"""SELECT part_id, regexp_replace(trim(brand), '\\s+', ' ', 'g') AS brand,
    regexp_replace(trim(model), '\\s+', ' ', 'g') AS model, year, sim_type, sim_count, cameras AS main_cameras_num,
    list_max(list_transform(regexp_extract_all(main_mp, '-?\\d+(?:\\.\\d+)?'), lambda x: TRY_CAST(x AS DOUBLE))) AS highest_maincam_res,
    inch AS display_size_inch, pixels AS resolution_pixels, base_os AS os_name, os_version, maker AS chipset_manufacturer,
    cores AS cpu_core_count, {_gb('storage')} AS internal_storage_gb, {_gb('ram')} AS ram_gb,
    mah AS battery_capacity_mah, status AS launch_status, weight, price AS price_eur FROM chain""")


@query("stage", raw_ctes(PIECES, EXPANDED, LISTED, PRICED, CHAIN, STAGED) + """
    SELECT * REPLACE (round(price_eur, 6) AS price_eur) FROM staged""")
def _(i):
    rows = plan.clean(i.raw_pages, i.prices, impute=False)
    return load.stage(rows).select(
        "part_id", "brand", "model", "year", "sim_type", "sim_count", "main_cameras_num", "highest_maincam_res",
        "display_size_inch", "resolution_pixels", "os_name", "os_version", "chipset_manufacturer", "cpu_core_count",
        "internal_storage_gb", "ram_gb", "battery_capacity_mah", "launch_status", "weight",
        F.round("price_eur", 6).alias("price_eur"))
