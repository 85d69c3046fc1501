import json

import pytest

from specloom.plans import adhoc, clean, recommend
from specloom.operators.load import stage
from specloom.sources import catalogue, pages, tables
from specloom.schemas import PRICE_SCHEMA, RAW_SCHEMA
from specloom.streaming.incremental import incremental_load


def raw_frame(spark):
    """Four pages, one per code path."""
    cols = {
        "brand": ["Apple", "Samsung", "alcatel", "Xiaomi"], "model": ["iPhone 15", "Galaxy S24", "A1", "Redmi Watch"],
        "Body_Dimensions": ["147.6 x 71.6 x 7.8 mm (5.81 x 2.82 in)", "162.3 x 79.0 x 8.6 mm", "Foldable", None],
        "Body_Weight": ["171 g (6.03 oz)", "196 g", None, "0.5 kg"],
        "Body_SIM": ["Nano-SIM and eSIM or Dual eSIM", "Single SIM (Nano-SIM)", "Dual SIM (Nano-SIM)", "No"],
        "Network_5G bands": ["1, 3, 5 SA/NSA", None, "n1, n3", None], "Battery_Type": ["Li-Ion 3349 mAh", "Li-Po 4000 mAh", None, "5000 mAh"],
        "Display_Size": ["6.1 inches, 90.2 cm2 (~86.4%)", "6.7 inches", None, "1.5 inches"],
        "Display_Resolution": ["1179 x 2556 pixels, 19.5:9 ratio (~460 ppi density)", None, None, "1080 x 2400 pixels"],
        "Platform_CPU": ["Hexa-core", "Octa-core", "Octa-core", None], "Platform_Chipset": ["Apple A16", "Qualcomm", None, None],
        "Platform_OS": ["iOS 17, upgradable", "Android 14", "Android 13", "MIUI 14"],
        "Memory_Internal": ["128GB 6GB RAM, 256GB 8GB RAM", "256GB 12GB RAM; 1TB 12GB RAM", "64GB", "128GB 6GB RAM (Africa), 64GB 4GB RAM (India)"],
        "Main Camera_Triple": ["48 MP wide + 12 MP", None, "108 MP", None], "Selfie camera_Single": ["12 MP", "12 MP", None, None],
        "Misc_Price": ["About 800 EUR", "$ 999.99 / £ 849.00", "About 250 EUR", None],
        "Launch_Announced": ["2023, September 12", "2024, January 17", "2024, January", "2009, August"],
        "Launch_Status": ["Available. Released 2023", "Available", "Discontinued", "Coming soon"],
        "Features_Sensors": ["Face ID, gyro", None, None, None], "Network_Technology": ["GSM / 5G"] * 4,
    }
    names = list(cols)
    return spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"`{c}` string" for c in names))


def test_clean_chain(spark):
    prices = spark.createDataFrame([("iPhone 15", "256GB 8GB RAM", "$ 1,089.00")], PRICE_SCHEMA)
    with pytest.raises(Exception, match="seq"):  # which of two listed prices is the last must be said
        clean.clean(raw_frame(spark), prices).collect()
    listed = prices.selectExpr("*", "2 AS seq").unionByName(prices.selectExpr("Model", "Configuration", "'$ 5.00' AS Price", "1 AS seq"))
    out = clean.clean(raw_frame(spark), listed)
    got = {(r.model, r.Storage): r for r in out.collect()}
    assert set(got) == {("iPhone 15", "128GB"), ("iPhone 15", "256GB"), ("Galaxy S24", "256GB"), ("Galaxy S24", "1TB")}
    assert got["iPhone 15", "128GB"].Price_EUR == 800.0
    assert got["iPhone 15", "256GB"].Price_EUR == pytest.approx(1089 * 0.93)
    assert got["Galaxy S24", "1TB"].Price_EUR == pytest.approx(999.99 * 0.93)
    one = got["iPhone 15", "128GB"]
    assert (one.year, one.Launch_Status, one["5G"], one["2G"], one.SIM_count) == (2023, "Available", 1, 0, "dual")
    assert (one.Resolution_Pixels, one.PPI_Density, got["Galaxy S24", "1TB"].Resolution_Pixels) == (1179 * 2556, 460.0, 0)
    assert "Memory_Internal" not in out.columns and "Misc_Price" not in out.columns
    staged = stage(out).filter("model = 'iPhone 15' AND internal_storage_gb = 256").first()
    assert (staged.ram_gb, staged.highest_maincam_res, staged.form_factor, staged.sensor_names) == (8, 48.0, "phone", ["face id", "gyro"])


def test_audit_keeps_every_row(spark):
    frame = clean.audit_frame(raw_frame(spark))
    assert frame.count() == 4 and set(clean.AUDITED) <= set(frame.columns)


def test_csv_round_trip_with_commas_quotes_and_no_rows(spark, tmp_path):
    df = spark.createDataFrame([("m", "256GB 8GB RAM", '$ 1,089.00 "x"\nnext'), ("n", "c", None)], PRICE_SCHEMA)
    tables.write_table(df, str(tmp_path / "a"), "csv")
    assert sorted(map(tuple, tables.read_csv(spark, str(tmp_path / "a"), PRICE_SCHEMA).collect())) == sorted(map(tuple, df.collect()))
    tables.write_table(df.limit(0).coalesce(1), str(tmp_path / "b"), "csv")
    texts = [p.read_text() for p in (tmp_path / "b").glob("*.csv")]
    assert texts == ["Model,Configuration,Price\n"]


def test_sources_are_split_where_records_end_with_lines(spark, tmp_path):
    df = spark.createDataFrame([(f"m{k}", "256GB, 8GB", f'$ {k} "x"') for k in range(3000)], PRICE_SCHEMA)
    broken = df.union(spark.createDataFrame([("m", "c", "two\nlines")], PRICE_SCHEMA))
    for name, rows in (("flat", df), ("broken", broken)):
        tables.write_table(rows.coalesce(1), str(tmp_path / name), "csv")
    (tmp_path / "lines.json").write_text("\n".join(json.dumps({f"b{k}": {"m": {"Body": {"Weight": str(k)}}}}) for k in range(3000)) + "\n\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        flat, whole = (tables.read_csv(spark, str(tmp_path / n), PRICE_SCHEMA) for n in ("flat", "broken"))
        assert flat.rdd.getNumPartitions() > 2 and whole.rdd.getNumPartitions() == 1
        assert sorted(map(tuple, flat.collect())) == sorted(map(tuple, df.collect()))
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, broken.collect()))
        found = catalogue.read_catalogue_json(spark, str(tmp_path / "lines.json"))
        assert found.rdd.getNumPartitions() > 2
        assert {(r.brand, r.details["Body"]["Weight"]) for r in found.collect()} == {(f"b{k}", str(k)) for k in range(3000)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_catalogue_and_price_json(spark, tmp_path):
    doc = {"Apple": {"iPhone": {"Body": {"Weight": "171 g"}, "Misc": None}}}
    (tmp_path / "c.json").write_text(json.dumps(doc, indent=2))
    row = catalogue.read_catalogue_json(spark, str(tmp_path / "c.json")).first()
    assert (row.brand, row.model, row.details["Body"], row.details["Misc"]) == ("Apple", "iPhone", {"Weight": "171 g"}, None)
    prices = {"old": {"128GB": "$799"}, "none": None, "new": {"scraped_at": "2026-05-09T12:00:00Z", "configs": {"a": "1", "b": "2"}},
              "part": {"scraped_at": "2026-05-09T12:00:00Z"}}
    (tmp_path / "p.json").write_text(json.dumps(prices))
    got = {r.model: (r.scraped_at, r.configs) for r in catalogue.read_price_json(spark, str(tmp_path / "p.json")).collect()}
    stamp = "2026-05-09T12:00:00Z"
    assert got == {"old": (None, {"128GB": "$799"}), "none": (None, None), "new": (stamp, {"a": "1", "b": "2"}), "part": (stamp, None)}
    assert catalogue.price_rows(catalogue.read_price_json(spark, str(tmp_path / "p.json"))).count() == 3
    assert catalogue.read_price_json(spark, str(tmp_path / "absent.json")).count() == 0
    (tmp_path / "bad.json").write_text("{not json")
    assert catalogue.read_price_json(spark, str(tmp_path / "bad.json")).count() == 0
    with pytest.raises(Exception, match="(?i)malformed"):
        catalogue.read_catalogue_json(spark, str(tmp_path / "bad.json")).collect()


def price_table(rows):
    return f'<html><table class="pricing inline widget">{rows}</table></html>'


@pytest.mark.parametrize("html,want", [
    (price_table('<tr><td>128GB 6GB RAM</td><td><a href="#">$799</a></td></tr><tr><td>256GB</td><td><a>€ 9</a></td></tr>'), {"128GB 6GB RAM": "$799", "256GB": "€ 9"}),
    ("<p>nothing</p>", {}), (price_table("<tr><th>Config</th><th>Price</th></tr>"), {}),
    (price_table('<tr><td>1</td><td>no link</td></tr><tr><td>  </td><td><a>x</a></td></tr><tr><td>2</td><td><a>y</a></td></tr>'), {"2": "y"}),
    ("<table><tr><td>nope", {}), (price_table('<tr><td>1</td><td><a>a</a></td></tr><tr><td>1</td><td><a>b</a></td></tr>'), {"1": "b"}), (None, {}),
])
def test_price_pages(spark, html, want):
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert {r.config: r.price for r in pages.extract_price_table(df).collect()} == want


def test_links_and_next_page(spark):
    html = ('<div class="makers"><ul><li><a href="a.php"><img src=x><span>One</span></a></li></ul></div><ul><li><a href="z">no</a></li></ul>'
            '<a class="prevnextbutton" title="Next page" href="p2.php">&gt;</a>')
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [tuple(r) for r in pages.extract_links(df, base="https://x.example/").collect()] == [(1, "One", "https://x.example/a.php")]
    assert [r.url for r in pages.next_page(df, "https://x.example/").collect()] == ["https://x.example/p2.php"]


@pytest.mark.parametrize("sql", [
    "", "  ;", "DROP TABLE t", "INSERT INTO t VALUES (1)", "SELECT 1; SELECT 2", "SHOW TABLES", "EXPLAIN SELECT 1", "CREATE TABLE x (a INT)",
    "SELECT 1) UNION (SELECT 2", "TRUNCATE TABLE t", "SELECT reflect('java.lang.System', 'exit', 0)", "SELECT java_method('a', 'b')",
    "SELECT * FROM parquet.`/tmp`", "SELECT TRANSFORM (id) USING 'cat' FROM range(3)", "WITH a AS (SELECT 1) DELETE FROM a",
])
def test_guard_rejects(spark, sql):
    with pytest.raises(adhoc.UnsafeSQLError):
        adhoc.guarded(spark, sql)


@pytest.mark.parametrize("sql,n", [
    ("SELECT id FROM range(7);", 7), ("WITH a AS (SELECT id FROM range(3)) SELECT * FROM a ORDER BY id DESC", 3),
    ("SELECT 1 AS x UNION SELECT 2", 2), ("SELECT 'drop table; reflect(' AS x -- note", 1), ("SELECT id FROM range(9) WHERE id > (SELECT avg(id) FROM range(9))", 4),
])
def test_guard_accepts(spark, sql, n):
    assert len(adhoc.guarded(spark, sql).collect()) == n


def test_cap_preview_and_timeout(spark):
    rows, cut = adhoc.run_readonly(spark, "SELECT id FROM range(20)", cap=5)
    assert len(rows) == 5 and cut
    assert adhoc.run_readonly(spark, "SELECT id FROM range(5)", cap=5)[1] is False
    text = adhoc.preview(spark.range(12).toDF("id"), 2)
    assert text.startswith("| id |\n|---|\n") and "…10 more row(s) not shown." in text and text.endswith("(returned 12 row(s))")
    assert adhoc.preview(spark.range(0)) == "(0 rows returned for columns: id)"
    slow = "SELECT count(*) FROM range(0, 100000000000, 1, 8) WHERE sqrt(id) % 3 = 7"
    with pytest.raises(Exception, match="(?i)cancel"):
        adhoc.run_readonly(spark, slow, seconds=1)


def test_request_validation():
    for bad in ({"limit": 0}, {"limit": 201}, {"min_ram_gb": -1}, {"sort_by": "x"}, {"form_factor": "car"}, {"sort_order": "up"}):
        with pytest.raises(ValueError):
            recommend.Request(**bad)


def test_incremental_load_rerun_adds_nothing(spark, tmp_path):
    src, target, ckpt = (str(tmp_path / d) for d in ("src", "star", "ckpt"))
    raw = clean.conform(raw_frame(spark), RAW_SCHEMA).select(*[f"`{c}`" for c in RAW_SCHEMA.names])
    raw.filter("brand = 'Apple'").write.mode("append").parquet(src)
    incremental_load(spark, src, target, ckpt, fmt="parquet")
    first = tables.read_star(spark, target).Device.count()
    raw.write.mode("append").parquet(src)  # the same page again, and new ones
    for _ in range(2):
        incremental_load(spark, src, target, ckpt, fmt="parquet")
    star = tables.read_star(spark, target)
    assert first == 2 and star.Device.count() == 4 and star.Device_Name.count() == 2
    assert sorted(r.id for r in star.Device.collect()) == [1, 2, 3, 4]


def test_pages_with_tags_that_never_close(spark):
    from specloom.sources import pages as p

    html = "<table>" + "<li>" * 3000 + '<a href="/x">deep</a>'
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert p.extract_links(df, css="li a").count() == 1
    assert all(r["value"] is None for r in p.extract_spec_tables(df).collect()) and p.extract_price_table(df).count() == 0
