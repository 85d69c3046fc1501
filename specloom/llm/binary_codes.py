"""Embedding near-duplicates by randomly rotated binary codes.

Equal vectors of a label are one class with a count. A class's unit vector is rotated at
random into `width` dimensions; the signs are its code, and the inner product of code and
vector is its stored correction factor. The product of a code with another vector, divided
by that factor, estimates the cosine without bias, and the factor gives the estimate's
confidence bound. Only pairs whose upper bound reaches the threshold are computed exactly.

Blocks: sign bits of further rotations, in as many tables as give a pair at the threshold
the chance `recall` to meet. Bits and tables follow from the number of vectors of the
largest label, so a block stays near `block` vectors at any size. A larger block is cut into
parts that are compared two by two. Every vector is indexed; nothing is sampled.

Defined results: one row per input row. Vectors that are null, zero, or hold null or
non-finite components, and rows without label or id link with nothing. Vectors of unequal
length never link. Rows of the same id are the same vector. Columns other than id,
embedding and label are left out. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.session import ship_package, store

from .components import components

SEED = 20


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column as doubles (null: NaN) and where each row begins."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(size)].astype(np.int64)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable rows with a digest of their vector."""
    for batch in batches:
        flat, begin = _flat(batch.column("embedding"))
        flat = flat + 0.0  # no negative zero
        total = np.r_[0.0, np.cumsum(np.where(np.isfinite(flat), np.abs(flat), 0.0))]
        bad = np.r_[0, np.cumsum(~np.isfinite(flat))]
        usable = (np.diff(begin) > 0) & (np.diff(bad[begin]) == 0)
        usable[usable] = [bool(np.any(flat[a:b])) for a, b in zip(begin[:-1][usable], begin[1:][usable], strict=True)]
        del total
        rows = np.flatnonzero(usable)
        digest = [hashlib.blake2b(flat[begin[i] : begin[i + 1]].tobytes(), digest_size=16).digest() for i in rows]
        yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), batch.column("label").take(pa.array(rows)), pa.array(digest, pa.binary())], ["id", "label", "digest"])


def rotation(size: int, width: int, seed: int) -> np.ndarray:
    """`size` orthonormal columns in `width` dimensions, uniform at random."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, seed, size]).standard_normal((width, size)))
    return q * np.sign(np.diag(r))


def bound(factor: np.ndarray, width: int, sigmas: float = 3.0) -> np.ndarray:
    """How far an estimate may be off, with the confidence of so many standard deviations."""
    return sigmas * np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / max(width - 1, 1))


def _width(size: int, width: int) -> int:
    return max(width, 64 * math.ceil(size / 64))


def _codes(batches: Iterator[pa.RecordBatch], width: int, bits: int, tables: int) -> Iterator[pa.RecordBatch]:
    """Code, correction factor, randomly rounded vector and block keys of each class."""
    for batch in batches:
        flat, begin = _flat(batch.column("embedding"))
        sizes = np.diff(begin)
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            u = flat[begin[rows][:, None] + np.arange(size)]
            u = u / np.abs(u).max(1, keepdims=True)
            u /= np.sqrt((u * u).sum(1, keepdims=True))
            wide = _width(size, width)
            turned = u @ rotation(size, wide, 0).T
            factor = np.abs(turned).sum(1) / math.sqrt(wide)
            code = np.packbits(turned > 0, axis=1)
            step = np.abs(u).max(1) / 127
            ids = batch.column("id").take(pa.array(rows))
            noise = np.random.default_rng([SEED, size]).random((1, size))  # random rounding keeps estimates unbiased
            rounded = np.clip(np.floor(u / step[:, None] + noise), -127, 127).astype(np.int8)
            keys = np.zeros((len(rows), tables), np.int64)
            for t in range(tables):
                planes = np.random.default_rng([SEED, size, t + 1]).standard_normal((bits, size))
                keys[:, t] = ((u @ planes.T > 0) @ (1 << np.arange(bits, dtype=np.int64))) if bits else 0
            yield pa.RecordBatch.from_arrays([
                ids, batch.column("label").take(pa.array(rows)), pa.array(np.full(len(rows), size, np.int32)), pa.array(factor), pa.array(step),
                pa.array([c.tobytes() for c in code], pa.binary()), pa.array([q.tobytes() for q in rounded], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * tables, pa.int32()), pa.array(keys.ravel()))],
                ["id", "label", "size", "factor", "step", "code", "rounded", "keys"])


def _near(table: pa.Table, threshold: float, width: int) -> pa.Table:
    """Pairs of one block whose upper bound reaches the threshold."""
    size = table["size"][0].as_py()
    wide = _width(size, width)
    bits = lambda c: np.unpackbits(np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(len(c), -1), axis=1)
    ids, factor, part = (table[c].to_numpy() for c in ("id", "factor", "part"))
    signs = bits(table["code"]).astype(np.float32)[:, :wide] * 2 - 1
    back = signs @ rotation(size, wide, 0).astype(np.float32) / math.sqrt(wide) / factor[:, None].astype(np.float32)
    step = table["step"].to_numpy()
    vectors = np.frombuffer(b"".join(table["rounded"].to_pylist()), np.int8).reshape(len(ids), size).astype(np.float32) * step[:, None].astype(np.float32)
    off = bound(factor, wide) + 3 * step * 0.5
    first, second = table["i"][0].as_py(), table["j"][0].as_py()
    a = np.flatnonzero(part == first)
    b = a if first == second else np.flatnonzero(part == second)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for s in range(0, len(a), 512):
        rows = a[s : s + 512]
        upper = np.minimum(back[rows] @ vectors[b].T + off[rows][:, None], vectors[rows] @ back[b].T + off[b][None, :])
        x, y = np.nonzero(upper >= threshold)
        x, y = ids[rows[x]], ids[b[y]]
        left.append(np.minimum(x, y)[x != y])
        right.append(np.maximum(x, y)[x != y])
    pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], 1), axis=0)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _cosines(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, begin = _flat(batch.column("x"))
        y, _ = _flat(batch.column("y"))
        keep = np.zeros(batch.num_rows, bool)
        sizes = np.diff(begin)
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            at = begin[rows][:, None] + np.arange(size)
            p, q = x[at], y[at]
            p, q = p / np.abs(p).max(1, keepdims=True), q / np.abs(q).max(1, keepdims=True)
            keep[rows] = (p * q).sum(1) / np.sqrt((p * p).sum(1) * (q * q).sum(1)) >= threshold
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b", "ma", "mb")], ["a", "b", "ma", "mb"])


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, recall: float = 0.99, block: int = 1024, width: int = 256, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("embedding"), F.col(label).alias("label"))
    kind = dict(rows.dtypes)["label"]
    usable = rows.where("id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").mapInArrow(_digests, f"id long, label {kind}, digest binary").distinct()
    classes = usable.groupBy("label", "digest").agg(F.min("id").alias("class_id"), F.count("*").alias("m"))
    members = store(usable.join(classes, ["label", "digest"]).select("id", "label", "class_id", "m"), "vectors")
    leaders = members.where("id = class_id").select("id", "label", "m").distinct()
    leaders = store(leaders.join(rows.dropDuplicates(["id", "label", "embedding"]), ["id", "label"]), "leaders")
    most = leaders.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(most, 1) / block)))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    tables = 1 if bits == 0 else math.ceil(math.log(1 - recall) / math.log(1 - meet))
    codes = leaders.mapInArrow(lambda it: _codes(it, width, bits, tables), f"id long, label {kind}, size int, factor double, step double, code binary, rounded binary, keys array<long>")
    keyed = store(codes.select("id", "label", "size", "factor", "step", "code", "rounded", F.posexplode("keys").alias("t", "key")), "codes")
    by = ["label", "size", "t", "key"]
    parts = keyed.groupBy(*by).agg(F.ceil(F.count("*") / F.lit(2 * block)).cast("int").alias("parts"))
    split = keyed.join(parts, by).withColumn("part", F.pmod(F.xxhash64("id", "t"), F.col("parts")).cast("int"))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
    pairs = split.groupBy(*by, "i", "j").applyInArrow(lambda t: _near(t, threshold, width), "a long, b long").distinct()
    held = leaders.select("id", "m", "embedding")
    exact = pairs.join(held.toDF("a", "ma", "x"), "a").join(held.toDF("b", "mb", "y"), "b").where("size(x) = size(y)")
    links = store(exact.mapInArrow(lambda it: _cosines(it, threshold), "a long, b long, ma long, mb long").distinct(), "links")
    degree = links.select(F.col("a").alias("class_id"), F.col("mb").alias("n")).union(links.select(F.col("b").alias("class_id"), F.col("ma").alias("n"))).groupBy("class_id").agg(F.sum("n").alias("others"))
    found = components(links).withColumnRenamed("id", "class_id")
    known = members.select("id", "class_id", "m").join(degree, "class_id", "left").join(found, "class_id", "left").select(
        "id", (F.col("m") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component_id", "class_id").alias("component_id"))
    known = known.groupBy("id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return rows.select("id").join(known, "id", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"), F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(False)).alias("kept"))
