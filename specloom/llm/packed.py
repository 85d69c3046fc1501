"""Shuffles of many small fixed-width records as packed binary rows.

A map task sorts its records by bucket and key and sends each bucket's records of a block as
one compressed row; the task of a bucket reads them back as numpy arrays. Bytes of one place
in the record lie together, so sorted keys and small numbers shrink to a few bytes, and a
very frequent key costs its records, not its rows. Buckets are hash ranges, two to a
shuffle partition, so their size is set where partitions are, or more for a large input.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import words as W

SHAPE = "bucket int, n int, packed binary"
#: Records that a map task holds before it sends them on.
BLOCK = 300_000
#: Bytes of input files that make a bucket, where the shuffle partitions are too few for them.
SHARE = 5_000_000


def _file_bytes(rows: DataFrame) -> int:
    """Size of the tables that the rows are read from; 0 if one is not known."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return size if size < 1 << 60 else 0


def buckets(spark: SparkSession, rows: DataFrame | None = None) -> int:
    """Two to a shuffle partition, or as many as the input of `rows` needs."""
    named = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return named if rows is None else max(named, math.ceil(_file_bytes(rows) / SHARE))


def squeeze(rows: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(rows.view(np.uint8).reshape(len(rows), -1).T)
    return pa.Codec("zstd", compression_level=1).compress(planes.tobytes(), asbytes=True)


def expand(data: bytes, n: int, kind: np.dtype) -> np.ndarray:
    planes = pa.Codec("zstd").decompress(data, n * kind.itemsize, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()


class Packer:
    """Collects record arrays and gives packed rows; the first field is the key."""

    def __init__(self, kind: np.dtype, count: int, distinct: bool = False, block: int = BLOCK):
        self.kind, self.count, self.distinct, self.block = kind, count, distinct, block
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, *fields: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = np.empty(len(fields[0]), self.kind)
        for name, values in zip(self.kind.names, fields, strict=True):
            rows[name] = values
        self.held.append(rows)
        self.size += len(rows)
        if self.size >= self.block:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            rows = np.concatenate(self.held)
            names = self.kind.names
            bucket = (W.mix(rows[names[0]].astype(np.uint64)) % np.uint64(self.count)).astype(np.int32)
            order = np.lexsort((*(rows[n] for n in reversed(names[1:] if self.distinct else ())), rows[names[0]], bucket))
            rows, bucket = rows[order], bucket[order]
            if self.distinct:
                new = np.zeros(len(rows), bool)
                new[0] = True
                for n in names:
                    new[1:] |= rows[n][1:] != rows[n][:-1]
                rows, bucket = rows[new], bucket[new]
            first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            ends = np.r_[first[1:], len(rows)]
            packed = [squeeze(rows[a:b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array((ends - first).astype(np.int32)), pa.array(packed, pa.binary())], ["bucket", "n", "packed"])
        self.held, self.size = [], 0


def unpack(table: pa.Table, kind: np.dtype) -> np.ndarray:
    """All records of a bucket."""
    parts = [expand(d, n, kind) for d, n in zip(table["packed"].to_pylist(), table["n"].to_pylist(), strict=True)]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def ordered(rows: np.ndarray, *names: str) -> np.ndarray:
    """Records sorted by fields, without repeats of all of them."""
    rows = rows[np.lexsort([rows[n] for n in reversed(names)])]
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for n in names:
        new[1:] |= rows[n][1:] != rows[n][:-1]
    return rows[new]


def per_bucket(rows: DataFrame, work: Callable[[pa.Table], pa.Table], shape: str) -> DataFrame:
    """Run `work` on all packed rows of each bucket."""

    def run(table: pa.Table) -> pa.Table:
        out = work(table)
        W.tidy()
        return out

    return rows.groupBy("bucket").applyInArrow(run, shape)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings and lengths of runs of equal sorted keys."""
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return first, np.diff(np.r_[first, len(keys)])
