"""Values of keys added up per row: sum(times * value of key) for rows that hold many keys.

A key with more than one in `HEAD` of all occurrences is looked up in a table that every task
gets: fewer than `HEAD` keys can be that frequent, whatever the input. All other occurrences
meet their key's values in hash buckets of packed records; none of those keys has more than
that share, so no bucket is hot, and what a bucket sends back is one sum a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructType

from specloom.session import ship_package, store

from . import packed as P
from . import words as W

#: Bound on the keys that travel to all tasks.
HEAD = 1 << 19
#: Gives, for each slice of a batch: the rows to keep, and of each key occurrence its row, the key, and how often.
Held = Callable[[pa.RecordBatch], Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]]
_TAIL = np.dtype([("key", np.uint64), ("row", np.int64), ("times", np.int64)])


def _sum_by(group: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.argsort(group, kind="stable")
    first, _ = P.runs(group[order])
    return group[order][first], [np.add.reduceat(v[order], first) if len(first) else v for v in values]


def _look_up(batches: Iterator[pa.RecordBatch], held: Held, head, names: list[str], values: list[str], count: int) -> Iterator[pa.RecordBatch]:
    """Rows with the sums of their frequent keys, and packed records of all others."""
    key, *known = head.value
    packer = P.Packer(_TAIL, count)
    every = [*names, "row", *values, "bucket", "n", "packed"]
    kinds: list[pa.DataType] = []

    def tail(made: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in made:
            yield pa.RecordBatch.from_arrays([*(pa.nulls(b.num_rows, t) for t in kinds), *b.columns], every)

    for batch in batches:
        ids = batch.column("row").to_numpy()
        at = 0
        for rows, row, keys, times in held(batch):
            own = ids[at : at + rows.num_rows]
            at += rows.num_rows
            place = np.searchsorted(key, keys)
            place[place == len(key)] = 0
            frequent = key[place] == keys if len(key) else np.zeros(len(keys), bool)
            hit, weight = place[frequent], times[frequent]
            sums = []
            for v in known:
                total = np.zeros(rows.num_rows, np.int64)
                np.add.at(total, row[frequent], v[hit] * weight)
                sums.append(pa.array(total))
            columns = [rows.column(c) for c in names]
            kinds = [*(c.type for c in columns), *[pa.int64()] * (1 + len(values))]
            empty = [pa.nulls(rows.num_rows, t) for t in (pa.int32(), pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(own), *sums, *empty], every)
            yield from tail(packer.add(keys[~frequent], own[row[~frequent]], times[~frequent]))
    yield from tail(packer.flush())


def _pack(batches: Iterator[pa.RecordBatch], kind: np.dtype, count: int) -> Iterator[pa.RecordBatch]:
    packer = P.Packer(kind, count)
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in kind.names]
        yield from packer.add(columns[0].view(np.uint64), *columns[1:])
    yield from packer.flush()


def _meet(left: pa.Table, right: pa.Table, kind: np.dtype) -> pa.Table:
    """One bucket: each row's sums over the values of its keys."""
    tail, values = P.unpack(left, _TAIL), P.unpack(right, kind)
    values = values[np.argsort(values["key"])]
    at = np.searchsorted(values["key"], tail["key"])
    row, sums = _sum_by(tail["row"], [values[v][at] * tail["times"] for v in kind.names[1:]])
    W.tidy()
    return pa.table({"row": row, **dict(zip(kind.names[1:], sums, strict=True))})


def add_up(rows: DataFrame, held: Held, keep: StructType, table: DataFrame, values: list[str]) -> DataFrame:
    """Rows (columns `keep`) with one sum for each value column of `table` (key, n, values: long).

    `table` has each key of the rows once with its number of occurrences `n`; it is read
    three times, so pass a stored one. Every input row gives one row, repeated ones too.
    """
    spark = rows.sparkSession
    ship_package(spark)
    count = P.buckets(spark)
    total = table.agg(F.sum("n")).first()[0] or 0
    frequent = table.where(F.col("n") > total // HEAD).select("key", *values).toArrow()
    key = frequent["key"].to_numpy().view(np.uint64)
    order = np.argsort(key)
    head = spark.sparkContext.broadcast((key[order], *(frequent[v].to_numpy()[order] for v in values)))  # fewer than HEAD entries
    names = keep.fieldNames()
    shape = StructType([*keep.fields])
    for name in ("row", *values):
        shape = shape.add(name, LongType())
    shape = shape.add("bucket", IntegerType()).add("n", IntegerType()).add("packed", BinaryType())
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    # written once, so that a row has one number in all that follows
    found = store(numbered.mapInArrow(lambda it: _look_up(it, held, head, names, values, count), shape), "looked-up")
    kind = np.dtype([("key", np.uint64), *((v, np.int64) for v in values)])
    rare = table.where(F.col("n") <= total // HEAD).select("key", *values).mapInArrow(lambda it: _pack(it, kind, count), P.SHAPE)
    tail = found.where("bucket IS NOT NULL").select("bucket", "n", "packed")
    back = ", ".join(f"{v} long" for v in values)
    met = tail.groupBy("bucket").cogroup(rare.groupBy("bucket")).applyInArrow(lambda a, b: _meet(a, b, kind), f"row long, {back}")
    added = met.groupBy("row").agg(*(F.sum(v).alias(f"rare_{v}") for v in values))
    whole = found.where("bucket IS NULL").drop("bucket", "n", "packed").join(added, "row", "left")
    return whole.select(*names, *((F.col(v) + F.coalesce(f"rare_{v}", F.lit(0))).alias(v) for v in values))
