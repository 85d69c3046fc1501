"""Star-schema load."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import MISSING_KEY
from ..functions import (
    clean_text, first_int, first_number, form_factor, max_number, memory_gb, row_signature, sensor_list,
)
from ..schemas import FOREIGN_KEYS, SIGNATURE_COLUMNS, STAGE_NAMES, STAGE_REQUIRED, STAR_SCHEMAS, UNIQUE_KEYS, Star
from ..session import drop_stored, store
from .filters import drop_all_null_keys
from .joins import key_columns, lookup_side, new_rows
from .ledger import Ledger
from .ranking import first_per_key
from .reshape import rename_and_require

# Which rule types each staged column.
INT_COLUMNS = ["main_cameras_num", "selfie_cameras_num", "battery_capacity_mah", "year", "cpu_core_count"]
CAMERA_COLUMNS = ["highest_maincam_res", "highest_selfiecam_res"]
DOUBLE_COLUMNS = [
    "display_size_inch", "display_size_cm", "screen_to_body_ratio", "ppi_density",
    "weight", "length", "width", "height", "volume", "price_eur",
]
TEXT_COLUMNS = [
    "brand", "model", "body_sim", "network_technology", "launch_status",
    "os_name", "os_version", "chipset_manufacturer", "resolution_ratio",
]
LOWER_TEXT_COLUMNS = ["sim_type", "sim_count"]

# Dimension columns in the staged table, where they differ from the stored name.
STAGED_AS = {"Network_Technology": {"technology": "network_technology"}}
# Dimensions that need every key part; the others only need one.
NEEDS_ALL_KEYS = {"Sim", "Platform"}


def stage(df: DataFrame) -> DataFrame:
    """The cleaned table with load types."""
    src = rename_and_require(df, STAGE_NAMES, STAGE_REQUIRED)
    kinds = dict(src.dtypes)

    def typed(cols, rule, spark_type):
        # a column that already has a numeric type needs no text rule
        return {
            c: (rule(F.col(c)) if kinds[c] == "string" else F.col(c)).cast(spark_type) for c in cols
        }

    payload = F.col("sensor_payload")
    if kinds["sensor_payload"].startswith("array"):
        payload = F.concat_ws(",", payload)
    cols = {
        **typed(INT_COLUMNS, first_int, "int"),
        **typed(["resolution_pixels"], first_int, "long"),
        **typed(CAMERA_COLUMNS, max_number, "double"),
        **typed(DOUBLE_COLUMNS, first_number, "double"),
        **{c: clean_text(F.col(c)) for c in TEXT_COLUMNS},
        **{c: clean_text(F.col(c), lowercase=True) for c in LOWER_TEXT_COLUMNS},
        **{f"supports_{g.lower()}": F.coalesce(first_int(F.col(g)), F.lit(0)).cast("int") for g in ("2G", "3G", "4G", "5G")},
        "internal_storage_gb": memory_gb(F.col("Storage")),
        "ram_gb": memory_gb(F.col("RAM")),
        "sensor_names": sensor_list(payload),
    }
    return src.withColumns(cols).withColumn("form_factor", form_factor(F.col("model")))


def dimension_rows(staged: DataFrame, table: str, ordinal: str) -> DataFrame:
    """One row per unique key, other columns from the first row of that key."""
    names = STAGED_AS.get(table, {})
    cols = [f.name for f in STAR_SCHEMAS[table].fields if f.name != "id"]
    keys = UNIQUE_KEYS[table]
    rows = staged.select(*[F.col(names.get(c, c)).alias(c) for c in cols], F.col(ordinal).alias("__at"))
    rows = rows.dropna(subset=keys) if table in NEEDS_ALL_KEYS else drop_all_null_keys(rows, keys)
    helpers = key_columns(rows, keys)
    picked = first_per_key(rows.withColumns(helpers), list(helpers), "__at")
    kinds = {f.name: f.dataType for f in STAR_SCHEMAS[table].fields}
    return picked.select(*[F.col(c).cast(kinds[c]).alias(c) for c in cols])


def assign_ids(df: DataFrame, keys: list[str], start: int = 0, id_col: str = "id", hex_digits: int | None = None) -> DataFrame:
    """Dense ids start+1, start+2, ... in the order of a digest of the natural key.

    The digest's first digits cut the rows into even buckets whatever the keys look
    like, so numbering needs no single-task sort and gives the same ids every time.
    Keys must be unique. A bucket holds some 100,000 rows, at most 16**6 buckets are cut;
    ids follow the digest, so they do not depend on the number of buckets. Without
    `hex_digits` the rows are stored first: they are counted and then read twice.
    """
    if hex_digits is None:
        df = store(df, "numbered")
        hex_digits = min(6, max(1, math.ceil(math.log(max(df.count(), 1) / 100_000 + 1, 16))))
    digest = F.md5(F.concat_ws("|", *key_columns(df, keys).values()))
    cut = df.withColumn("__digest", digest).withColumn("__bucket", F.substring("__digest", 1, hex_digits))
    sizes = cut.groupBy("__bucket").agg(F.count("*").alias("__n"))
    # a row for every 100,000 of the table: numbered in one task, joined by its size
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    place = F.row_number().over(Window.partitionBy("__bucket").orderBy("__digest"))
    numbered = cut.withColumn("__place", place).join(offsets, "__bucket")
    new_id = (F.col("__offset") + F.col("__place") + F.lit(start)).cast("long")
    return numbered.withColumn(id_col, new_id).select(id_col, *[c for c in df.columns if c != id_col])


def first_known(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """The first row of each normalised key, rows without any key part left out."""
    known = drop_all_null_keys(df, keys)
    helpers = key_columns(known, keys)
    return first_per_key(known.withColumns(helpers), list(helpers), ordinal).drop(*helpers)


def unseen(df: DataFrame, existing: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Rows to append: some key part known, first of its key in the batch, not in the target."""
    return new_rows(first_known(df, keys, ordinal), existing, keys)


def open_target(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A stored star table as of the last recorded batch, empty before the first load."""
    return Ledger(spark, root).read(table, STAR_SCHEMAS[table])


def append_dimension(ledger: Ledger, table: str, staged: DataFrame, ordinal: str, last: int) -> tuple[list[str], int]:
    """L02 + L03 + L04 for one dimension: new keys into the coming batch.

    Only stored files that may hold a key of the batch are read. Returns the files and folders
    in which all keys of the batch are found, and the number of new rows.
    """
    keys = UNIQUE_KEYS[table]
    rows = store(dimension_rows(staged, table, ordinal))
    holding = ledger.files_holding(table, rows, keys)
    fresh = new_rows(rows, ledger.read(table, STAR_SCHEMAS[table], holding), keys)
    numbered = assign_ids(fresh, keys, start=last)
    added = ledger.write(table, numbered.select(*STAR_SCHEMAS[table].fieldNames()), keys)
    drop_stored(rows)
    return holding + [ledger.folder(ledger.number)] * bool(added), added


def fact_rows(staged: DataFrame, star: Star) -> DataFrame:
    """Staged rows with all seven dimension ids and the row signature; NULL ids stay.

    Only the key texts and the fact's own columns travel through the joins. Repeated
    rows end up with equal signatures, so they need no wide comparison before.

    No dimension has a row for a key without any part (or with a part missing, where all are
    needed). Such rows, often a large share, get a key that stands for nothing and differs by
    their other columns: they spread over all tasks and come out with a NULL id, as they must.
    """
    keys = {}
    for fk, table in FOREIGN_KEYS.items():
        names = STAGED_AS.get(table, {})
        keys[fk] = key_columns(staged, [names.get(k, k) for k in UNIQUE_KEYS[table]], f"__{fk}_")
    own = [c for c in SIGNATURE_COLUMNS if c not in FOREIGN_KEYS]
    for fk, table in FOREIGN_KEYS.items():
        gone = [c == MISSING_KEY for c in keys[fk].values()]
        hopeless = F.greatest(*gone) if table in NEEDS_ALL_KEYS else F.least(*gone) if len(gone) > 1 else gone[0]
        nothing = F.concat(F.lit("\u0000"), F.xxhash64(*own).cast("string"))  # key texts are trimmed: none begins so
        keys[fk] = {k: F.when(hopeless, nothing).otherwise(c) for k, c in keys[fk].items()}
    rows = staged.select(*own, *[c.alias(k) for parts in keys.values() for k, c in parts.items()])
    for fk, table in FOREIGN_KEYS.items():
        side = lookup_side(getattr(star, table), UNIQUE_KEYS[table], fk, f"__{fk}_")
        rows = rows.join(side, list(keys[fk]), "left")
    return rows.select(row_signature(rows, SIGNATURE_COLUMNS).alias("device_key"), *SIGNATURE_COLUMNS)


def append_facts(ledger: Ledger, staged: DataFrame, star: Star, last: int) -> int:
    """L06 into the coming batch: equal signatures are one row; known ones are skipped. Returns the number of new rows."""
    keys = UNIQUE_KEYS["Device"]
    # every column is part of the signature, so any row of a key is the same row
    facts = store(fact_rows(staged, star).dropDuplicates(keys))
    known = ledger.read("Device", STAR_SCHEMAS["Device"], ledger.files_holding("Device", facts, keys))
    numbered = assign_ids(new_rows(facts, known, keys), keys, start=last)
    added = ledger.write("Device", numbered.select(*STAR_SCHEMAS["Device"].fieldNames()), keys)
    drop_stored(facts)
    return added


def load_star(spark: SparkSession, root: str, staged: DataFrame, ordinal: str, label: str | None = None) -> None:
    """The whole load as one batch, dimensions first. Running it again adds nothing.

    The seven dimensions do not depend on each other, so their jobs run side by side. All
    eight tables become visible together, by a record written last; a load that broke before
    leaves nothing behind that a reader or the next load would see. A `label` names the batch:
    one that is recorded already is skipped.
    """
    ledger = Ledger(spark, root)
    if label is not None and ledger.knows(label):
        return
    last = ledger.last_ids({t: STAR_SCHEMAS[t] for t in UNIQUE_KEYS})
    dims = list(FOREIGN_KEYS.values())
    with ThreadPoolExecutor(len(dims)) as pool:
        load_one = inheritable_thread_target(spark)(append_dimension)
        jobs = {t: pool.submit(load_one, ledger, t, staged, ordinal, last[t]) for t in dims}
        done = {t: job.result() for t, job in jobs.items()}
    sides = {t: ledger.read(t, STAR_SCHEMAS[t], names) for t, (names, _) in done.items()}
    added = {t: n for t, (_, n) in done.items()}
    added["Device"] = append_facts(ledger, staged, Star(Device=ledger.read("Device", STAR_SCHEMAS["Device"], []), **sides), last["Device"])
    ledger.commit(label, {t: last[t] + n for t, n in added.items()}, added)
