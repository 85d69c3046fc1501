"""Batches of a stored star: visible together, safe to repeat, found by key."""

import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from specloom.catalog.inputs import Inputs
from specloom.operators import ledger as ledgers
from specloom.operators import load
from specloom.operators.ledger import Ledger
from specloom.plans.clean import clean
from specloom.schemas import FOREIGN_KEYS, STAR_SCHEMAS, UNIQUE_KEYS
from specloom.session import ship_package, store
from specloom.sources.tables import read_star
from specloom.streaming import incremental


def pages(spark, upto):
    return Inputs(spark, "/root/testdata/sf0.001").raw_pages.filter(F.col("part_id") < upto)


def staged(raw):
    rows = load.stage(clean(raw.drop("part_id"), impute=False)).withColumn("at", F.monotonically_increasing_id())
    return store(rows)


def keys_of(star):
    """Rows of every table by natural key; facts with the keys of their dimensions instead of ids."""
    out = {}
    facts = star.Device.drop("id", "device_key")
    for fk, table in FOREIGN_KEYS.items():
        dim = getattr(star, table)
        key = F.lower(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in UNIQUE_KEYS[table]]))
        out[table] = sorted(r[0] for r in dim.select(key).collect())
        facts = facts.join(dim.select(F.col("id").alias(fk), key.alias(f"k_{fk}")), fk, "left").drop(fk)
    out["Device"] = sorted(map(str, facts.select(*sorted(facts.columns)).collect()))
    return out


def test_bit_tables_hold_their_keys_and_hardly_others():
    rng = np.random.default_rng(5)
    inside, outside = (rng.integers(-2**63, 2**63 - 1, 20_000, dtype=np.int64) for _ in range(2))
    bits = ledgers.bloom(inside)
    assert all(ledgers.may_hold(bits, inside[i:i + 1]) for i in range(0, 20_000, 7))
    assert sum(ledgers.may_hold(bits, outside[i:i + 1]) for i in range(20_000)) <= 1
    assert not ledgers.may_hold(bits, inside[:0])


def test_a_load_that_breaks_leaves_nothing_and_ends_equal(spark, tmp_path, monkeypatch):
    """The second micro-batch dies between dimensions and facts, and again before its record."""
    raw = pages(spark, 40)
    names = [f"`{c}`" for c in raw.columns if c != "part_id"]
    src, one, two, ckpt = (str(tmp_path / k) for k in ("in", "one", "two", "ckpt"))
    raw.filter("part_id < 20").select(*names).write.mode("append").parquet(src)
    incremental.incremental_load(spark, src, two, ckpt, fmt="parquet")
    before = keys_of(read_star(spark, two))
    raw.filter("part_id >= 15").select(*names).write.mode("append").parquet(src)

    def broken(*_):
        raise RuntimeError("lost")

    for owner, name in ((load, "append_facts"), (Ledger, "commit")):
        with monkeypatch.context() as patch:
            patch.setattr(owner, name, broken)
            with pytest.raises(StreamingQueryException):
                incremental.incremental_load(spark, src, two, ckpt, fmt="parquet")
        assert (tmp_path / "two" / "Device_Name" / "batch-000002").exists()
        assert keys_of(read_star(spark, two)) == before
    incremental.incremental_load(spark, src, two, ckpt, fmt="parquet")
    load.load_star(spark, one, staged(raw), "at")
    star = read_star(spark, two)
    assert keys_of(star) == keys_of(read_star(spark, one))
    for table in STAR_SCHEMAS:  # dense ids over both batches
        ids = sorted(r.id for r in getattr(star, table).select("id").collect())
        assert ids == list(range(1, len(ids) + 1)), table


def test_a_recorded_label_is_skipped_and_a_taken_number_refused(spark, tmp_path):
    root, rows = str(tmp_path / "star"), staged(pages(spark, 6))
    load.load_star(spark, root, rows, "at", label="a")
    load.load_star(spark, root, staged(pages(spark, 12)), "at", label="a")
    assert Ledger(spark, root).numbers == {1}
    late = Ledger(spark, root)
    load.load_star(spark, root, rows, "at", label="b")
    with pytest.raises(RuntimeError):
        late.commit("c", {}, {})


def test_a_batch_reads_only_files_that_may_hold_its_keys(spark, tmp_path):
    """Six batches of own keys; a batch with keys of the third reads that one, and new keys read none."""
    root, schema = str(tmp_path / "t"), STAR_SCHEMAS["OS"]
    for number in range(6):
        ledger = Ledger(spark, root)
        rows = spark.range(number * 500, number * 500 + 500).select(
            F.col("id"), F.concat(F.lit("os "), F.col("id")).alias("os_name"), F.lit(None).cast("string").alias("os_version"))
        assert ledger.write("OS", rows, UNIQUE_KEYS["OS"]) == 500
        ledger.commit(None, {"OS": number * 500 + 499}, {"OS": 500})
    ledger = Ledger(spark, root)
    assert ledger.last_ids({"OS": schema}) == {"OS": 2999}

    def probe(*numbers):
        rows = spark.createDataFrame([(f" OS {n}", None) for n in numbers], "os_name string, os_version string")
        names = ledger.files_holding("OS", rows, UNIQUE_KEYS["OS"])
        fresh = load.new_rows(rows, ledger.read("OS", schema, names), UNIQUE_KEYS["OS"])
        read = ledger.read("OS", schema, names).inputFiles() if names else []
        return {n.split("/")[0] for n in names}, len(read) == len(names), sorted(r.os_name for r in fresh.collect())

    assert probe(1001, 1499, 7777) == ({"batch-000003"}, True, [" OS 7777"])
    assert probe(*range(5000, 5200)) == (set(), True, sorted(f" OS {n}" for n in range(5000, 5200)))
    assert probe(0, 2999)[0] == {"batch-000001", "batch-000006"}
    assert probe() == (set(), True, [])


def test_files_of_other_means_are_always_read(spark, tmp_path):
    """Tables written before the first recorded batch: kept, asked for keys, ids go on from theirs."""
    root, raw = str(tmp_path / "star"), pages(spark, 8)
    load.load_star(spark, str(tmp_path / "old"), staged(raw.filter("part_id < 5")), "at")
    old = read_star(spark, str(tmp_path / "old"))
    for table in STAR_SCHEMAS:
        getattr(old, table).write.parquet(f"{root}/{table}")
    assert keys_of(read_star(spark, root)) == keys_of(old)
    load.load_star(spark, root, staged(raw), "at")
    load.load_star(spark, str(tmp_path / "one"), staged(raw), "at")
    star = read_star(spark, root)
    assert keys_of(star) == keys_of(read_star(spark, str(tmp_path / "one")))
    ids = sorted(r.id for r in star.Device.select("id").collect())
    assert ids == list(range(1, len(ids) + 1))


def test_an_empty_load_is_recorded(spark, tmp_path):
    root = str(tmp_path / "star")
    load.load_star(spark, root, staged(pages(spark, 3)).limit(0), "at")
    assert Ledger(spark, root).numbers == {1} and read_star(spark, root).Device.count() == 0


def test_append_reads_one_batch_and_skips_replays(spark, tmp_path, monkeypatch):
    """Keys land once, spelled in any way; rows without a key part are left out; a replayed batch adds nothing."""
    src, target, ckpt = (str(tmp_path / k) for k in ("in", "out", "ckpt"))
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, " A ")], "v int, k string").coalesce(1)
    asked = []
    plain = Ledger.files_holding
    monkeypatch.setattr(Ledger, "files_holding", lambda *a: asked.append(plain(*a)) or asked[-1])
    for part in (first, spark.createDataFrame([(5, "c"), (6, "B")], first.schema), spark.createDataFrame([(7, "d")], first.schema)):
        part.write.mode("append").parquet(src)
        for _ in range(2):
            incremental.incremental_append(spark, src, target, ckpt, first.schema, ["k"])
    got = sorted(r.k for r in incremental.appended(spark, target, first.schema).collect())
    assert got == ["a", "b", "c", "d"]
    assert [{n.split("/")[0] for n in names} for names in asked] == [set(), {"batch-000001"}, set()]
    # the same files by a new stream: known keys are found, nothing is added
    incremental.incremental_append(spark, src, target, str(tmp_path / "again"), first.schema, ["k"])
    assert incremental.appended(spark, target, first.schema).count() == 4


def test_threads_ship_the_package_once():
    shipped = []

    def add(path):
        time.sleep(0.1)
        if shipped:  # as Spark does with a second archive of one name
            raise ValueError("already registered with a different path")
        shipped.append(path)

    session = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="shipped by threads", addPyFile=add))
    with ThreadPoolExecutor(7) as pool:
        list(pool.map(ship_package, [session] * 7))
    assert len(shipped) == 1
