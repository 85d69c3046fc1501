"""Rule by rule: input texts and the values they must give."""

import pytest
from pyspark.sql import functions as F

from specloom import functions as fn
from specloom.functions.text import strip


def test_storage_and_ram(apply):
    cases = {
        "128GB 6GB RAM": ("128GB", "6GB"), "256GB 12GB RAM": ("256GB", "12GB"),
        "128GB (122GB user available), 6GB RAM": ("128GB", "6GB"), "4GB RAM, 64GB ROM": ("64GB", "4GB"),
        "128GB/256GB, 8GB RAM": ("256GB", "8GB"), "64GB ROM, 4GB RAM": ("64GB", "4GB"),
        "128GB (Africa), 6GB RAM": ("128GB", "6GB"), "64GB": ("64GB", None), "512MB RAM": (None, "512MB"),
        "foldable variant": (None, None), "1.5 TB 8 GB RAM": ("1.5 TB", "8 GB"),
    }
    assert [tuple(r) for r in apply(fn.storage_and_ram, list(cases))] == list(cases.values())


def test_sim(apply):
    texts = ["Nano-SIM and eSIM or Dual eSIM", "Single SIM (Nano-SIM)", "Triple SIM (Nano-SIM)", "Micro-SIM", "eSIM",
             "No", "none", "-", None, "Yes", "card"]
    assert apply(fn.sim_type, texts) == ["nano", "nano", "nano", "micro", "esim", "none", "none", "none", None, "unknown", "unknown"]
    assert apply(fn.sim_count, texts) == ["dual", "single", "triple", "single", "single", "none", "none", "none", None, "single", "none"]


def test_weight_ignores_unit(apply):
    assert apply(fn.weight_g, ["171 g (6.03 oz)", "0.5 kg", "-", None]) == [171.0, 0.5, None, None]


@pytest.mark.parametrize("text,length,width,height,volume", [
    ("147.6 x 71.6 x 7.8 mm (5.81 x 2.82 x 0.31 in)", 147.6, 71.6, 7.8, 147.6 * 71.6 * 7.8),
    ("156.8 x Unknown x 8 mm", 156.8, None, 8.0, None), ("247 x 179 mm", 247.0, 179.0, None, None),
    ("8.1 mm thickness", None, None, 8.1, None), ("Folded thickness: 10 mm", None, None, 10.0, None),
    ("100 cc", None, None, None, 100.0), ("Foldable", None, None, None, None), ("  -  ", None, None, None, None),
    (None, None, None, None, None),
])
def test_dimensions(apply, text, length, width, height, volume):
    got = apply(fn.dimensions, [text])[0]
    assert (got.length, got.width, got.height) == (length, width, height)
    assert got.volume == (pytest.approx(volume) if volume else None)


def test_battery(apply):
    texts = ["Li-Ion 3349 mAh, non-removable", "Li-Ion 303.8 mAh (1.19 Wh)", "Li-Po 10,050 mAh", "Li-Po (28.93 Wh)", None, "302.5 mah"]
    assert apply(fn.battery_mah, texts) == [3349, 304, 10050, None, None, 302]


def test_display_and_resolution(apply):
    size = apply(fn.display_size, ["6.1 inches, 90.2 cm2 (~86.4% screen-to-body ratio)", "6.7 inches", None])
    assert [tuple(s) for s in size] == [(6.1, 90.2, 86.4), (6.7, None, None), (None, None, None)]
    res = apply(fn.resolution, ["1179 x 2556 pixels, 19.5:9 ratio (~460 ppi density)", "480 x 800 pixels, 5:3 ratio (233 ppi)"])
    assert [tuple(r) for r in res] == [("1179 x 2556", "19.5:9", 460.0), ("480 x 800", "5:3", 233.0)]
    assert apply(fn.pixel_count, ["1179 x 2556", None]) == [1179 * 2556, 0]


def test_base_os(apply):
    cases = {
        "iOS 17.4": "iOS", "Android 14, One UI 6.1": "Android", "Harmony OS 4.0": "HarmonyOS", "Android-based, OMS 2.5": "Android",
        "Symbian^3, Anna": "Symbian", "EMUI 12": "EMUI", "Microsoft Windows Phone 8.1": "Microsoft", "Wear OS": "Wear OS",
        "Blue OS 3.0": "Blue OS", "Firefox OS 1.3": "Firefox OS", "Firefox 2.0, upgradable": "Firefox OS", "Wear OSx": "Wear",
    }
    assert apply(fn.base_os, list(cases)) == list(cases.values())
    assert apply(fn.os_version, ["Android 14, One UI 6.1", "iOS 17.4.1", "none", None]) == ["14", "17.4.1", None, None]


def test_chipset_cores_slot_status(apply):
    assert apply(fn.chipset_maker, ["Apple A16", "Samsung Exynos 2400", "Some chip", None]) == ["Apple", "Samsung", "Other", "Other"]
    assert apply(fn.cpu_cores, ["Octa-core (1x3)", "deca-core", "Single-core", "", "  ", None]) == [8, 10, 1, None, None, None]
    assert apply(fn.card_slot, ["microSDXC", "No", "Yes", None, "nanoMemory", "MMC", "slot"]) == ["Microsd", "No", "Yes", None, "No", "Mmc", "Unknown"]
    assert apply(fn.launch_status, ["Available. Released", "Discontinued", "Cancelled", "Coming soon", "Rumored", "garbage", None]) == [
        "Available", "Discontinued", "Canceled", "Rumored", "Rumored", None, None]


def test_prices(apply):
    texts = ["About 800 EUR", "$ 999.00", "₹ 12,499", "£ 849.00", "1234.56", "€ 800 / $ 899 / £ 729", "$ 1,089.00",
             "Listed at $549 (was £499). About 600 EUR", "C$ 799.99", None]
    want = [800.0, 999 * 0.93, 12499 * 0.011, 849 * 1.17, None, 800.0, 1089 * 0.93, 600.0, 799.99 * 0.93, None]
    assert apply(fn.price_eur, texts) == [None if w is None else pytest.approx(w) for w in want]
    assert apply(fn.price_source, texts)[:5] == ["EUR-native", "from USD", "from INR", "from GBP", "unrecognised"]


def test_memory(apply):
    cases = {"8GB": 8, "1.5GB": 2, "1.1GB": 1, "1TB": 1024, "768MB": 1, "4MB": 1, "0GB": None, "not a number": None, "": None}
    assert apply(fn.memory_gb, list(cases)) == list(cases.values())
    tiers = {"1TB 12GB RAM, 512GB 8GB RAM": 2, "256 GB": 1, "Variants: 128GB / 256GB / 512GB": 1, "": 0, "128GB 6GB RAM (Africa, India)": 1}
    assert apply(fn.storage_tiers, list(tiers)) == list(tiers.values())


def test_numbers(apply):
    assert apply(fn.first_number, ["5.2 inches", "~460 ppi", "-3.14", "no", ""]) == [5.2, 460.0, -3.14, None, None]
    assert apply(fn.first_int, ["5.7 inch", "8GB", "-2.9", "x"]) == [5, 8, -2, None]
    assert apply(fn.max_number, ["12 + 48 + 12 MP", "13.5 MP", "LED flash only", None]) == [48.0, 13.5, None, None]
    assert apply(fn.highest_mp, ["48 MP wide + 12 MP", "VGA", "qcif or svga", "Yes", None]) == ["48.0", "0.307", "0.48", "Yes", None]


def test_clean_text_and_sensors(apply):
    assert apply(fn.clean_text, ["  Apple   iPhone  15 ", "nan", " ", None, "a  b"]) == ["Apple iPhone 15", None, None, None, "a b"]
    texts = ["['Face ID', 'gyro', 'GYRO']", "Fingerprint, accelerometer,  compass", "", None, "['a, b', 'c']", "[x, y,]", "'only'"]
    assert apply(fn.sensor_list, texts) == [["face id", "gyro"], ["fingerprint", "accelerometer", "compass"], [], [], ["a, b", "c"], ["x", "y"], ["only"]]


def test_lookup_key_matches_python_format(apply):
    values = [8.0, 8.5, 28565.55, 28565.65, 293.8755, 0.0001234565, 100000.5, 100001.5, 1234567.5, 1e-5, 2.5e-7, -28565.55, 123456.5,
              0.1, 1e20, -3.0, 0.5, 99999.95, 999999.5, 999999.7, 99999.97, 0.00123456789, 0.0999999999, -0.05, 4.9999999,
              1234.5678, 0.01, 56.7890125, 9.999995, 9.9999949, 6.02214076e-12, None, float("nan")]

    def want(v):
        if v is None or v != v:
            return "__missing__"
        return str(int(v)) if float(v).is_integer() else format(v, "g")

    assert apply(lambda c: fn.lookup_key(c, "double"), values, "double") == [want(v) for v in values]
    assert apply(lambda c: fn.lookup_key(c, "string"), ["  Apple  ", "8.0", "8.5", None, "1e3", "12abc"]) == ["apple", "8", "8.5", "__missing__", "1000", "12abc"]


def test_form_factor(apply):
    cases = {"Galaxy Watch Active Band": "watch", "Gear S3": "watch", "Galaxy Tab S9": "tablet", "iPad Pro": "tablet", "Mi Band 7": "band", "iPhone 15": "phone"}
    assert apply(fn.form_factor, [*cases, None]) == [*cases.values(), "other"]


def test_staleness(apply):
    now = F.lit("2026-05-20 12:00:00").cast("timestamp")
    stamps = ["2026-05-06T12:00:00Z", "2026-05-06T11:59:59Z", "bad", None]
    assert apply(lambda c: fn.is_stale(c, 14, now), stamps) == [False, True, True, True]
    assert apply(lambda c: fn.is_stale(c, None, now), stamps) == [False] * 4


def test_misc_rules(spark, apply):
    assert apply(fn.is_sentinel, ["", " NaN ", "unknown", "none", None, "x"]) == [True, True, True, True, True, False]
    assert apply(lambda c: fn.canonical(c, fn.BRAND_SPELLING), ["alcatel", "LG"]) == ["Alcatel", "LG"]
    assert apply(fn.launch_year, ["2023, September 12", "Not announced yet", "Q3", None]) == [2023, None, None, None]
    assert apply(fn.size_class, [6.99, 7.0, None], "double") == ["small", "large", "small"]
    assert apply(fn.video_res, ["4K@60fps, HDR", "1080p ", None]) == ["4K", "1080p ", None]
    assert apply(lambda c: fn.comparable(c, "double"), [1.00004, 2.0, None], "double") == ["1.0", "2.0", None]
    assert apply(fn.is_block_page, ["<p>Just a moment...</p>", "fine"]) == [True, False]
    row = spark.createDataFrame([(None, "x", None, "y")], "a string, b string, c string, d string")
    assert row.select(fn.count_from_populated({"a": 1, "b": 2, "c": 3, "d": 5}).alias("n")).first().n == 5


def test_strip_takes_every_unicode_space(apply):
    spaces = "".join(chr(c) for c in range(0x3001) if chr(c).isspace() and not 0x1C <= c <= 0x1F)
    texts = [spaces + "a b" + spaces, "a\n", "​x​", spaces, "", None, "é　"]
    assert apply(strip, texts) == ["a b", "a", "​x​", "", "", None, "é"]
