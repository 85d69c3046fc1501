"""Masked moments: sums over pairwise complete rows, in one pass over Arrow batches.

With X the values of a batch (centred, NULL as zero) and M the mask of what is known, four
matrix products give for every pair of columns the number of rows that know both, both sums,
both sums of squares and the sum of products over exactly those rows. A task keeps one set of
pair moments (count, means, centred second moments) and merges batches by the pairwise update
formula, so no shift has to be known in advance and no digits are lost; Spark merges the
tasks' sets the same way, one row a column. Work and size depend on the number of columns
only: gaps cost nothing, whichever columns have them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

#: A pair's moments over its complete rows: count, mean of a and of b, second moments of a, of b and of both.
PARTS = ("n", "mean_a", "mean_b", "m2_a", "m2_b", "cross")
_PACKED = "i int, " + ", ".join(f"{p} array<double>" for p in PARTS)


def batch_moments(x: np.ndarray) -> np.ndarray:
    """Moments of all column pairs of a matrix with NaN gaps, stacked in the order of PARTS."""
    known = ~np.isnan(x)
    mask = known.astype(float)
    count = mask.sum(0)
    centre = np.where(count > 0, np.where(known, x, 0.0).sum(0) / np.maximum(count, 1), 0.0)
    y = np.where(known, x - centre, 0.0)
    n, first, square, cross = mask.T @ mask, y.T @ mask, (y * y).T @ mask, y.T @ y
    least = np.maximum(n, 1)
    second = square - first * first / least
    second[second <= 1e-12 * square] = 0.0  # no spread among a pair's rows, up to rounding
    return np.stack([n, centre[:, None] + first / least, (centre[:, None] + first / least).T, second, second.T, cross - first * first.T / least])


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows together."""
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    dx, dy = b[1] - a[1], b[2] - a[2]
    weight = a[0] * share
    return np.stack([n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dx * weight, a[4] + b[4] + dy * dy * weight, a[5] + b[5] + dx * dy * weight])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns])


def _pack(held: np.ndarray) -> pa.RecordBatch:
    k = held.shape[1]
    begin = pa.array(np.arange(k + 1) * k, pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(k, dtype=np.int32)), *(pa.ListArray.from_arrays(begin, pa.array(part.ravel())) for part in held)], ["i", *PARTS])


def _of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        if batch.num_rows:
            one = batch_moments(_matrix(batch))
            held = one if held is None else merge(held, one)
    if held is not None:
        yield _pack(held)


def _merged(table: pa.Table) -> pa.Table:
    """All tasks' moments of one column with every other: pairs of sets are merged until one is left."""
    sets = np.stack([np.concatenate([np.asarray(v, float)[None, :] for v in table[p].to_pylist()]) for p in PARTS], 1)
    while len(sets) > 1:
        odd = sets[-1:] if len(sets) % 2 else sets[:0]
        half = len(sets) // 2
        sets = np.concatenate([np.stack([merge(sets[2 * i], sets[2 * i + 1]) for i in range(half)]), odd])
    return pa.table({"i": table["i"][:1], **{p: pa.array([v.tolist()], pa.list_(pa.float64())) for p, v in zip(PARTS, sets[0], strict=True)}})


def pair_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_a, column_b, n, mean_a, mean_b, m2_a, m2_b, cross) for every ordered pair of columns.

    All six are over the rows that know both columns; means are NULL where there is none. NaN
    counts as a gap. A table without rows gives n = 0 for every pair.
    """
    spark = df.sparkSession
    ship_package(spark)
    cols = list(cols)
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    k = len(cols)
    # a set without rows for every column, so that each has one where no task had any
    nothing = spark.range(k).select(F.col("id").cast("int").alias("i"), *[F.array_repeat(F.lit(0.0), k).alias(p) for p in PARTS])
    merged = rows.mapInArrow(_of_task, _PACKED).union(nothing).groupBy("i").applyInArrow(_merged, _PACKED)
    names = F.array(*[F.lit(c) for c in cols])
    at = F.transform(names, lambda c, j: F.struct(c.alias("column_b"), *[F.get(p, j).alias(p) for p in PARTS]))
    out = merged.select(F.get(names, F.col("i")).alias("column_a"), F.inline(at))
    some = F.col("n") > 0
    return out.select(
        "column_a", "column_b", F.col("n").cast("long").alias("n"), *[F.when(some, F.col(p)).alias(p) for p in PARTS[1:]])


def correlation(moments: DataFrame) -> DataFrame:
    """(column_a, column_b, n, r): Pearson r; NULL below two rows or without spread."""
    spread = lambda m2, mean: F.col(m2) > F.col("n") * F.pow(F.col(mean) * 1e-14, 2)
    r = F.col("cross") / F.sqrt(F.col("m2_a")) / F.sqrt(F.col("m2_b"))
    known = (F.col("n") >= 2) & spread("m2_a", "mean_a") & spread("m2_b", "mean_b")
    return moments.select("column_a", "column_b", "n", F.when(known, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r"))
