import pytest
from pyspark.sql import functions as F

from specloom.operators import aggregates, filters, impute, joins, load, ordered, quality, ranking, reshape, sets
from specloom.schemas import CHECK_RULES, STAR_SCHEMAS, UNIQUE_KEYS


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("data,missing,expected", [
    ([("Apple", "iPhone 15", 2023, 800.0), ("Apple", "iPhone 15", 2023, None)], 1, [800.0, 800.0]),
    ([("S", m, 2024, p) for m, p in zip("ABCD", (400.0, 500.0, 600.0, None))], 1, [400.0, 500.0, 600.0, 500.0]),
    ([("X", m, y, p) for m, y, p in zip("ABCDEF", (2020, 2020, 2021, 2021, 2022, 2099), (200.0, 300.0, 400.0, 500.0, 600.0, None))], 1,
     [200.0, 300.0, 400.0, 500.0, 600.0, 400.0]),
    ([("O", "X", 2020, 123.0), ("O", "Y", 2020, None)], 1, [123.0, None]),
    ([("A", m, 2024, p) for m, p in zip(("i", "i", "X", "Y", "Z", "M"), (800.0, None, 400.0, 500.0, 600.0, None))], 2,
     [800.0, 800.0, 400.0, 500.0, 600.0, 550.0]),
])
def test_impute_cascade(spark, data, missing, expected):
    df = frame(spark, [(i, *r) for i, r in enumerate(data)], "i int, brand string, model string, year int, Price_EUR double")
    got = impute.impute_cascade(df)
    assert got.columns == df.columns
    assert [r.Price_EUR for r in got.orderBy("i").collect()] == expected
    assert sum(r.n for r in impute.impute_counts(df).collect()) == missing


def test_quantiles_on_a_hot_key(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"),
        ((F.col("id") * 7919) % 1009).cast("double").alias("v"))
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 1.0}
    got = {r.k: tuple(r)[1:] for r in ordered.quantiles(df, ["k"], "v", probs, ranges=16).collect()}
    want = {r.k: tuple(r.q) for r in df.groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, probs.values()))).alias("q")).collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert got[k] == pytest.approx(want[k])


def test_ranked_value_counts_with_one_value(spark):
    df = frame(spark, [("a", 5.0)] * 4 + [("b", None)], "k string, v double")
    assert rows(ordered.ranked_value_counts(df, ["k"], "v")) == [("a", 5.0, 4, 0, 4)]
    assert rows(ordered.every_kth(df, "v", 3), "position") == [(0, 5.0), (3, 5.0)]


def test_histogram_edges(spark):
    df = frame(spark, [(float(v),) for v in (0, 1, 2, 9, 10)], "v double")
    assert [(r.bin, r.n) for r in aggregates.histogram(df, "v", 10).orderBy("bin").collect()] == [(0, 1), (1, 1), (2, 1), (9, 2)]
    same = frame(spark, [(3.0,)] * 4, "v double")
    assert [(r.bin, r.n) for r in aggregates.histogram(same, "v", 5).collect()] == [(0, 4)]


def test_group_summary_std_of_one_row(spark):
    df = frame(spark, [("a", 1.0), ("b", 1.0), ("b", 3.0)], "k string, v double")
    assert rows(aggregates.group_summary(df, ["k"], "v"), "k") == [("a", 1, 1.0, None, 1.0), ("b", 2, 2.0, pytest.approx(2**0.5), 2.0)]


def test_form_filter_rejects_unknown():
    with pytest.raises(ValueError):
        filters.form_filter("phone'; DROP")


def test_complete_cases(spark):
    df = frame(spark, [(1.0, 2.0, None), (2.0, None, None), (None, 1.0, None)], "y double, a double, b double")
    kept, dropped = filters.complete_cases(df, "y", ["a", "b"])
    assert rows(kept) == [(1.0, 2.0)] and dropped == ["b"]


def test_required_columns(spark):
    df = frame(spark, [(1,)], "a int")
    with pytest.raises(ValueError, match="missing"):
        reshape.rename_and_require(df, {"a": "b"}, ["b", "c"])
    with pytest.raises(ValueError):
        reshape.drop_required(df, ["zz"])


def test_flatten_json(spark):
    docs = frame(spark, [(1, '{"a": {"b": 1, "c": [true, {"d": null}]}, "e": {}, "f": "{\\"x\\": 1}"}'), (2, "[10, [20]]")], "id int, doc string")
    got = {(r.id, r.path): r.value for r in reshape.flatten_json(docs, "doc", ["id"]).collect()}
    assert got == {(1, "a_b"): "1", (1, "a_c_0"): "true", (1, "a_c_1_d"): None, (1, "f"): '{"x": 1}', (2, "0"): "10", (2, "1_0"): "20"}


def test_flatten_json_any_depth_and_broken_text(spark):
    deep = '{"k": ' * 12 + "7" + "}" * 12
    docs = frame(spark, [(1, deep), (2, "{oops"), (3, None), (4, "5")], "id int, doc string")
    got = sorted((r.id, r.path or "", r.value) for r in reshape.flatten_json(docs, "doc", ["id"]).collect())
    assert got == [(1, "_".join("k" * 12), "7"), (2, "__broken", "{oops"), (3, "", None), (4, "", "5")]


def test_override_last_price_wins(spark):
    df = frame(spark, [("m", "128GB", "6GB", "old"), ("m", "256GB", "8GB", "old"), ("n", "128GB", "6GB", None)], "model string, Storage string, RAM string, Misc_Price string")
    prices = frame(spark, [("m", "128GB 6GB RAM", "$ 1", 1), ("m", "128GB 6GB RAM", "$ 2", 2), ("x", "128GB 6GB RAM", "$ 9", 3)], "Model string, Configuration string, Price string, at int")
    got = reshape.override_price(df, prices, ordinal="at")
    assert rows(got.select("model", "Storage", "Misc_Price"), "model", "Storage") == [("m", "128GB", "$ 2"), ("m", "256GB", "old"), ("n", "128GB", None)]


def test_attach_lookup_id_null_matches_null(spark):
    df = frame(spark, [(1, "Apple ", None), (2, "apple", 8.0), (3, "LG", 8.0)], "i int, brand string, x double")
    dim = frame(spark, [(7, "APPLE", None), (9, "Apple", 8.0)], "id long, brand string, x double")
    assert rows(joins.attach_lookup_id(df, dim, ["brand", "x"], "dim_id").select("i", "dim_id"), "i") == [(1, 7), (2, 9), (3, None)]


def test_work_queue(spark):
    known = frame(spark, [("a", "u1"), ("b", "u2"), ("c", "u3")], "model string, url string")
    done = frame(spark, [("u2",), ("u2",)], "url string")
    assert rows(joins.work_queue(known, done).select("model"), "model") == [("a",), ("c",)]
    assert rows(joins.work_queue_counts(known, done)) == [(3, 2, 1)]


def test_refresh_queue_limit(spark):
    two = "128GB 6GB RAM, 256GB 8GB RAM"
    devices = frame(spark, [("a", two), ("b", two), ("c", "64GB"), ("d", two)], "model string, Memory_Internal string")
    urls = frame(spark, [("a", "ua"), ("b", "ub"), ("c", "uc")], "model string, url string")
    seen = frame(spark, [("a", "2026-05-19T00:00:00Z"), ("b", None)], "model string, scraped_at string")
    now = F.lit("2026-05-20 00:00:00").cast("timestamp")
    states = joins.refresh_states(devices, urls, seen, 7, now)
    assert rows(states.select("model", "state"), "model") == [("a", "fresh"), ("b", "queued"), ("d", "missing_url")]
    assert joins.refresh_queue(devices, urls, seen, 7, now, limit=1).count() == 1


def test_ranking(spark):
    df = frame(spark, [("a", 1, 5.0), ("a", 2, 9.0), ("b", 3, None), ("b", 4, 2.0)], "k string, i int, v double")
    assert rows(ranking.best_per_key(df, ["k"], "v", 5)) == [("a", 2, 9.0), ("b", 4, 2.0)]
    assert rows(ranking.first_per_key(df, ["k"], "i"), "k") == [("a", 1, 5.0), ("b", 3, None)]
    assert rows(ranking.last_n_per_session(df, "k", "i", 1).select("k", "i", "place"), "k") == [("a", 2, 1), ("b", 4, 1)]
    one, two = (ranking.hash_sample(df, 2, ["i"], seed=3).collect() for _ in range(2))
    assert one == two
    with pytest.raises(ValueError):
        ranking.last_n_per_session(df, "k", "i", 0)


def test_results_equivalent(spark):
    a = frame(spark, [(1, 1.0), (2, None)], "x int, y double")
    assert sets.results_equivalent(a, frame(spark, [(None, 2), (1.00000001, 1)], "y double, x int"))
    assert not sets.results_equivalent(a, frame(spark, [(1, 1.0), (2, 0.0)], "x int, y double"))
    assert not sets.results_equivalent(a, frame(spark, [(1, 1.0), (1, 1.0), (2, None)], "x int, y double"))
    assert not sets.results_equivalent(a, frame(spark, [(1, 1.0), (2, None)], "x int, z double"))
    assert sets.results_equivalent(a.orderBy("x"), frame(spark, [(1.0, 1.0), (2.0, None)], "x double, y double").orderBy("x"), "ordered")
    assert not sets.results_equivalent(a.orderBy("x"), a.orderBy(F.desc("x")), "ordered")


def test_assign_ids_dense_and_stable(spark):
    df = spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"))
    first = {r.k: r.id for r in load.assign_ids(df, ["k"], start=10).collect()}
    again = {r.k: r.id for r in load.assign_ids(df.repartition(7), ["k"], start=10).collect()}
    assert first == again and sorted(first.values()) == list(range(11, 511))


STAGED = (
    "at int, brand string, model string, network_technology string, sim_count string, sim_type string, main_cameras_num int,"
    "selfie_cameras_num int, highest_maincam_res double, highest_selfiecam_res double, display_size_inch double,"
    "display_size_cm double, screen_to_body_ratio double, resolution_pixels long, resolution_ratio string, ppi_density double,"
    "os_name string, os_version string, chipset_manufacturer string, cpu_core_count int, internal_storage_gb int, ram_gb int,"
    "year int, launch_status string, battery_capacity_mah int, weight double, length double, width double, height double,"
    "volume double, price_eur double, form_factor string, sensor_names array<string>"
)


def staged_rows(spark):
    def row(at, brand, model, tech, sim, storage, cores=8, sensors=("gyro",)):
        return (at, brand, model, tech, sim, "nano", 3, 1, 48.0, 12.0, 6.1, 90.2, 86.4, 3013524, "19.5:9", 460.0, "iOS", "17", "Apple",
                cores, storage, 6, 2023, "Available", 3349, 171.0, 147.6, 71.6, 7.8, 82.4, 800.0, "phone", list(sensors))

    return frame(spark, [
        row(1, "Apple", "iPhone 15", "GSM / 5G", "dual", 128), row(2, "Apple", "iPhone 15", "GSM / 5G", "dual", 256),
        row(3, "Samsung", "S24", "GSM / LTE", "single", 256), row(4, "LG", "V60", "GSM / LTE", "triple", None, None),
        row(5, "apple ", "IPHONE 15", "GSM / 5G", "dual", 128, sensors=("other",)),
    ], STAGED)


def test_load_star_is_idempotent(spark, tmp_path):
    root, staged = str(tmp_path / "star"), staged_rows(spark)
    for _ in range(2):
        load.load_star(spark, root, staged, "at")
    count = {t: load.open_target(spark, root, t).count() for t in STAR_SCHEMAS}
    assert count == {"Device_Name": 3, "Network_Technology": 2, "Sim": 3, "Camera": 1, "Display": 1, "OS": 1, "Platform": 2, "Device": 4}
    device = load.open_target(spark, root, "Device")
    assert sorted(r.id for r in device.collect()) == [1, 2, 3, 4]
    assert device.filter("platform_id IS NULL").count() == 1
    names = load.open_target(spark, root, "Device_Name")
    assert names.filter("brand = 'Apple' AND model = 'iPhone 15'").count() == 1
    assert quality.check_fk(device, "device_name_id", names).count() == 0


@pytest.mark.parametrize("table,bad,rule", [
    ("Sim", {"sim_count": "quad"}, "ck_sim_count_valid"), ("Camera", {"main_cameras_num": -1}, "ck_main_cameras_num_min"),
    ("Camera", {"highest_maincam_res": 0.0}, "ck_highest_maincam_res_pos"), ("Display", {"display_size_inch": -1.0}, "ck_display_size_inch_pos"),
    ("Platform", {"ram_gb": 0}, "ck_ram_gb_pos"), ("Device", {"price_eur": -1.0}, "ck_price_eur_min"), ("Device", {"year": 1990}, "ck_year_range"),
    ("Device", {"launch_status": "Gone"}, "ck_launch_status_valid"), ("Device", {"form_factor": "car"}, "ck_form_factor_valid"),
    ("Device", {"volume": 0.0}, "ck_volume_pos"),
])
def test_each_broken_rule_is_found(spark, table, bad, rule):
    fields = STAR_SCHEMAS[table].fields
    values = [bad.get(f.name, 1 if f.name == "id" else None) for f in fields]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields))
    assert [r.rule for r in quality.check_rules(df, CHECK_RULES[table], ["id"]).collect()] == [rule]


def test_unique_null_and_fk(spark):
    df = frame(spark, [(1, "a", None), (2, "a", None), (3, "b", "x"), (4, "b", "x")], "id int, k string, l string")
    assert rows(quality.check_unique(df, ["k", "l"])) == [("b", "x", 2)]
    assert rows(quality.check_not_null(df, ["k", "l"], ["id"]), "id") == [(1, "l"), (2, "l")]
    child = frame(spark, [(1, 10), (2, None), (3, 99)], "id int, fk long")
    parent = frame(spark, [(10,), (11,)], "id long")
    assert [r.id for r in quality.check_fk(child, "fk", parent).collect()] == [3]
    assert rows(quality.still_referenced(parent, child, "fk")) == [(10,)]
    assert set(UNIQUE_KEYS) == set(STAR_SCHEMAS)


def test_many_ranges_rank_like_few(spark):
    from specloom.operators.ordered import ranked_value_counts

    df = frame(spark, [("a" if v % 3 else "b", float(v % 701)) for v in range(3000)], "g string, v double")
    few, many = (rows(ranked_value_counts(df, ["g"], "v", ranges=n).select("g", "v", "n", "before", "total"), "g", "v") for n in (1, 640))
    assert few == many


def test_incremental_load_equals_one_load(spark, tmp_path):
    """Two batches with a repeated product without a price give the facts of one load."""
    from pyspark.sql import functions as F

    from specloom.catalog.inputs import Inputs
    from specloom.operators import load
    from specloom.plans.clean import clean
    from specloom.schemas import FOREIGN_KEYS, STAR_SCHEMAS, UNIQUE_KEYS
    from specloom.session import store
    from specloom.streaming.incremental import filled_prices, incremental_load

    i = Inputs(spark, "/root/testdata/sf0.001")
    raw = i.raw_pages.filter("part_id < 60")
    names = [f"`{c}`" for c in raw.columns if c != "part_id"]
    src, one, two = (str(tmp_path / k) for k in ("in", "one", "two"))
    for part in ("part_id < 30", "part_id >= 20"):  # products 20 to 29 come twice
        raw.filter(part).select(*names).write.mode("append").parquet(src)
        incremental_load(spark, src, two, str(tmp_path / "ckpt"), fmt="parquet")
    staged = store(load.stage(clean(raw.drop("part_id"), impute=False)).withColumn("at", F.monotonically_increasing_id()))
    load.load_star(spark, one, staged, "at")
    for table in STAR_SCHEMAS:
        if table != "Device":
            a, b = (load.open_target(spark, t, table).select(*[F.lower(F.trim(F.col(k).cast("string"))) for k in UNIQUE_KEYS[table]]) for t in (one, two))
            assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), table
    facts = []
    for t in (one, two):
        device = load.open_target(spark, t, "Device").drop("id", "device_key", *[fk for fk in FOREIGN_KEYS if fk != "device_name_id"])
        named = load.open_target(spark, t, "Device_Name").select(F.col("id").alias("device_name_id"), F.lower(F.trim("model")).alias("model"))
        facts.append(sorted(map(str, device.join(named, "device_name_id").drop("device_name_id").collect())))
    assert facts[0] == facts[1] and facts[0]
    assert filled_prices(spark, two).count() == len(facts[1])


@pytest.mark.parametrize("listed,tracked", [(200, 10_000), (30, 64), (25, 32)])
def test_audit_of_skewed_and_even_texts(spark, listed, tracked):
    """One hot text, many texts of one row each, equal counts, several raw columns, nothing lost: all as a full count gives them."""
    import random
    from collections import Counter

    from specloom.operators.audit import audit_all

    rng = random.Random(listed)
    rows = []
    for k in range(3000):
        a = rng.choice([None, "hot", "hot", "hot", f"rare {k}", f"mid {k % 40}"])
        b = rng.choice([None, f"only {k}"])
        c = rng.choice([None, "x"])
        rows.append((a, b, c, None if rng.random() < 0.8 else "ok", rng.choice([" Unknown ", "fine"]), 1.0, rng.choice([0, 1])))
    df = spark.createDataFrame(rows, "`raw a` string, b string, c string, `clean a` string, both string, kept double, flag int").repartition(6)
    columns = {"clean a": ["raw a"], "both": ["b", "c"], "kept": ["c"]}
    got = audit_all(df, columns, ["flag"], top=20, listed=listed, tracked=tracked)
    lost = {"clean a": Counter(r[0] for r in rows if r[0] is not None and r[3] is None),
            "both": Counter(f"{r[1] or ''} | {r[2] or ''}" for r in rows if (r[1] or r[2]) and r[4] == " Unknown "), "kept": Counter()}
    there = {"clean a": sum(r[0] is not None for r in rows), "both": sum(bool(r[1] or r[2]) for r in rows), "kept": sum(r[2] is not None for r in rows)}
    assert {tuple(r) for r in got.counts.collect()} == {(c, 3000, there[c], sum(lost[c].values())) for c in columns}
    want = {(c, t, n) for c in columns for t, n in sorted(lost[c].items(), key=lambda p: (-p[1], p[0]))[:20]}
    assert {tuple(r) for r in got.values.collect()} == want
    assert {tuple(r) for r in got.flags.collect()} == {("flag", v, sum(r[6] == v for r in rows)) for v in (0, 1)}
    empty = audit_all(df.limit(0), columns, ["flag"])
    assert empty.values.count() == 0 and {tuple(r) for r in empty.counts.collect()} == {(c, 0, 0, 0) for c in columns}
