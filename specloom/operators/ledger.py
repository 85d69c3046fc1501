"""Batches of a stored star: written apart, made visible together, found again by key.

Layout below a root folder:

    <table>/batch-000012/        rows that batch 12 added
    _keys/<table>/batch-000012/  Bloom summaries of the keys in those files
    _batches/000012-<label>.json the record of batch 12, written last

Readers take the folders of recorded batches only, so the eight tables change together
and what a crashed load left behind is never seen; the next load takes the same number
and overwrites it. One writer a root: a second one fails when it writes its record.
Files directly below a table's folder (written by other means) always count as visible.

The driver holds folder and file names, never rows or keys.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .joins import key_columns

#: A file's keys are summarised in this many parts by hash, so that probing spreads over tasks.
SLICES = 64
#: At 32 or more bits and 16 probes a key not in the file passes with chance 3.3e-7.
BITS_PER_KEY = 32
PROBES = 16
#: Hashes that meet one summary at a time.
BLOCK = 16_384

SUMMARY = T.StructType([
    T.StructField("folder", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("slice", T.LongType()), T.StructField("bits", T.BinaryType()),
])


class Ledger:
    """The recorded batches below `root`, as they were when this object was made."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        records = sorted(n for n, _ in self._list("_batches") if n.endswith(".json"))
        self.numbers = {int(n.split("-")[0]) for n in records}
        self.labels = {n.split("-")[1].removesuffix(".json") for n in records}
        self.number = max(self.numbers, default=0) + 1  # of the batch to come
        self._newest = records[-1] if records else None

    def path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self.path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _list(self, *parts: str) -> list[tuple[str, bool]]:
        """(name, is a folder) of what lies in a folder; nothing if there is none."""
        fs, path = self._fs(), self.path(*parts)
        if not fs.exists(path):
            return []
        return [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(path)]

    def folder(self, number: int) -> str:
        return f"batch-{number:06d}"

    def knows(self, label: str) -> bool:
        return _digest(label) in self.labels

    def _visible(self, *parts: str) -> list[str]:
        """Names below a table's folder that recorded batches, or other means, put there."""
        known = {self.folder(n) for n in self.numbers}
        return [n for n, _ in self._list(*parts) if (n in known if n.startswith("batch-") else n[0] not in "._")]

    def read(self, table: str, schema: T.StructType, names: list[str] | None = None) -> DataFrame:
        """Rows of the named files and folders below a table's folder, of all visible ones if none are given."""
        names = self._visible(table) if names is None else names
        if not names:
            return self.spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]))
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{table}/{n}" for n in names])

    def files_holding(self, table: str, rows: DataFrame, keys: list[str]) -> list[str]:
        """Visible files that may hold a key of `rows`: every one that does, and hardly another.

        `rows` should be stored, it is read twice. Files without a summary are always named.
        """
        plain = [n for n in self._visible(table) if not n.startswith("batch-")]
        summaries = self._visible("_keys", table)
        if not summaries:
            return plain
        ship_package(self.spark)
        index = self.spark.read.schema(SUMMARY).parquet(*[f"{self.root}/_keys/{table}/{n}" for n in summaries])
        blocks = max(1, math.ceil(rows.count() / (SLICES * BLOCK)))
        key = key_hash(rows, keys)
        probes = (
            rows.select(key.alias("h")).groupBy(slice_of(F.col("h")).alias("slice"), F.pmod(F.shiftright("h", 8), F.lit(blocks)).alias("block"))
            .agg(F.collect_set("h").alias("hashes")).drop("block")
        )
        met = index.join(probes, "slice").select("folder", "name", "bits", "hashes")
        hit = met.mapInArrow(_probe, "folder string, name string").distinct()
        return plain + sorted(f"{r['folder']}/{r['name']}" for r in hit.collect())

    def write(self, table: str, rows: DataFrame, keys: list[str]) -> int:
        """Write the coming batch's rows of a table and the summaries of their keys; how many there are."""
        here = self.folder(self.number)
        target, summary = f"{self.root}/{table}/{here}", f"{self.root}/_keys/{table}/{here}"
        rows.write.mode("overwrite").parquet(target)
        stored = self.spark.read.schema(rows.schema).parquet(target)
        added = stored.count()
        if not added:
            for parts in ((table, here), ("_keys", table, here)):
                self._fs().delete(self.path(*parts), True)
            return 0
        ship_package(self.spark)
        hashed = stored.select(F.lit(here).alias("folder"), F.col("_metadata.file_name").alias("name"), key_hash(stored, keys).alias("h"))
        hashed.mapInArrow(_summarise, SUMMARY).write.mode("overwrite").parquet(summary)
        return added

    def last_ids(self, tables: dict[str, T.StructType]) -> dict[str, int]:
        """The highest id of each table: from the newest record, else from the rows."""
        if self._newest:
            text = self.spark.read.text(f"{self.root}/_batches/{self._newest}", wholetext=True).first()[0]
            return json.loads(text)["last_ids"]
        top = {t: self.read(t, s).agg(F.max("id")).first()[0] if self._visible(t) else 0 for t, s in tables.items()}
        return {t: v or 0 for t, v in top.items()}

    def commit(self, label: str | None, last_ids: dict[str, int], added: dict[str, int]) -> None:
        """Make the coming batch visible: its record is written aside and renamed in one step."""
        name = f"{self.number:06d}-{_digest(label if label is not None else f'load {self.number}')}.json"
        if any(n.split("-")[0] == f"{self.number:06d}" for n, _ in self._list("_batches")):
            raise RuntimeError(f"batch {self.number} of {self.root} was recorded by another writer")
        fs, aside = self._fs(), self.path("_batches", f".{name}")
        out = fs.create(aside, True)
        out.write(bytearray(json.dumps({"batch": self.number, "label": label, "last_ids": last_ids, "added": added}).encode()))
        out.close()
        if not fs.rename(aside, self.path("_batches", name)):
            raise RuntimeError(f"the record of batch {self.number} could not be written")


def _digest(label: str) -> str:
    return hashlib.md5(label.encode()).hexdigest()


def key_hash(df: DataFrame, keys: list[str]) -> Column:
    """64 bits of the normalised key."""
    return F.xxhash64(*key_columns(df, keys).values())


def slice_of(h: Column) -> Column:
    return F.pmod(h, F.lit(SLICES)).cast("long")


def _places(h: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The bits of each hash, one probe at a time; `size` is a power of two."""
    h = h.view(np.uint64)
    step = ((h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    at = h >> np.uint64(6)  # the low bits chose the slice
    for _ in range(PROBES):
        at = at + step
        yield ((at ^ (at >> np.uint64(31))) & np.uint64(size - 1)).astype(np.int64)


def bloom(h: np.ndarray) -> bytes:
    """A bit table of the hashes (int64)."""
    size = 1 << max(6, math.ceil(math.log2(BITS_PER_KEY * len(h))))
    bits = np.zeros(size, bool)
    for at in _places(h, size):
        bits[at] = True
    return np.packbits(bits, bitorder="little").tobytes()


def may_hold(bits: bytes, h: np.ndarray) -> bool:
    """Is any of the hashes, by all its bits, in the table?"""
    table = np.frombuffer(bits, np.uint8)
    left = np.ones(len(h), bool)
    for at in _places(h, len(table) * 8):
        left &= (table[at >> 3] >> (at & 7)) & 1 == 1
        if not left.any():
            return False
    return True


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of a scan task, whose size Spark bounds, to one bit table a file and slice.

    A file read by several tasks has several tables; each is asked.
    """
    found: dict[tuple[str, str], list[np.ndarray]] = {}
    for batch in batches:
        names = pa.table([batch.column(0), batch.column(1)], ["folder", "name"])
        hashes = batch.column(2).to_numpy(zero_copy_only=False)
        codes = names["name"].combine_chunks().dictionary_encode()
        at = codes.indices.to_numpy(zero_copy_only=False)
        for code, name in enumerate(codes.dictionary.to_pylist()):
            found.setdefault((names["folder"][0].as_py(), name), []).append(hashes[at == code])
    for (folder, name), parts in found.items():
        h = np.unique(np.concatenate(parts))
        part = np.mod(h, SLICES)
        cut = [(int(s), bloom(h[part == s])) for s in np.unique(part)]
        yield pa.RecordBatch.from_arrays([
            pa.array([folder] * len(cut)), pa.array([name] * len(cut)),
            pa.array([s for s, _ in cut], pa.int64()), pa.array([b for _, b in cut], pa.binary()),
        ], ["folder", "name", "slice", "bits"])


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files of the rows whose bit table may hold one of the row's hashes."""
    for batch in batches:
        lists = batch.column(3)
        hit = [may_hold(batch.column(2)[i].as_py(), lists[i].values.to_numpy(zero_copy_only=False)) for i in range(batch.num_rows)]
        yield batch.select([0, 1]).filter(pa.array(hit, pa.bool_()))
