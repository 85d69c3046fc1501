"""Embedding whitening on the principal components of the distinct vectors.

Entries become whole numbers, floor(64 * c) + 1000000, so equal rows are equal exactly and
sums are exact. The fit list holds each distinct vector once. Its sums per dimension come
first, then the covariance of the centred entries: every task adds up the products of its own
rows as one matrix, row r of all tasks is added up where r hashes to, and only the finished
matrix (dimensions squared, nothing that grows with the rows) reaches the driver. There QDWH
spectral divide-and-conquer (`spectral`) splits it into components. Mean and components are
broadcast, and a last pass over the fit list measures the covariance of what comes out.

Defined results: rows whose vector is null or empty, or holds null or non-finite entries or
any beyond 2**46 in size (which no double tells apart after scaling), are left out. Vectors of
unequal length are fitted apart, each length as a table of its own. Components without
variance (eigenvalue at most 1e-13 of the trace) are left out, so a list of one distinct
vector gives no rows. Repeated rows and ids each give their rows; a deviation too large for a
long is null. Other columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.session import ship_package, store

from . import words as W
from .binary_codes import _flat
from .spectral import components

SCALE, SHIFT = 64, 1_000_000
LIMIT = 2.0**46


@dataclass
class Model:
    """A length's number of distinct vectors, their sums, and per component vector / sqrt(e) and e / trace."""

    n: int
    sums: list[int]
    turn: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n as doubles, from the exact whole and the exact rest of each mean."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(float) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - S)**2 of each row, exact; None past a long."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = [s % self.n for s in self.sums]
        away = x - whole
        if len(x) and x.shape[1] * (self.n * (int(np.abs(away).max()) + 1)) ** 2 < 1 << 63:
            return ((self.n * away - np.array(rest, np.int64)) ** 2).sum(1).tolist()
        out = [sum((self.n * a - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in away.tolist()]
        return [v if v < 1 << 63 else None for v in out]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable rows with their entries as whole numbers."""
    for batch in batches:
        flat, begin = _flat(batch.column("embedding"))
        with np.errstate(invalid="ignore", over="ignore"):
            bad = np.r_[0, np.cumsum(~(np.abs(flat) <= LIMIT))]
        keep = (np.diff(begin) > 0) & (np.diff(bad[begin]) == 0)
        size = np.diff(begin)
        x = np.floor(SCALE * np.where(np.repeat(keep, size), flat, 0.0)).astype(np.int64) + SHIFT
        x = x[np.repeat(keep, size)]
        at = np.r_[0, np.cumsum(size[keep])]
        yield pa.RecordBatch.from_arrays([batch.column("id").filter(pa.array(keep)), W.ragged(x, at, pa.int64())], ["id", "x"])


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """The vectors of a batch as matrices, one for each length, with their rows."""
    for batch in batches:
        column = batch.column("x")
        flat, size = column.flatten().to_numpy(), column.value_lengths().to_numpy()
        begin = np.r_[0, np.cumsum(size)]
        for d in np.unique(size).tolist():
            rows = np.flatnonzero(size == d)
            yield d, flat[begin[rows][:, None] + np.arange(d)], batch.take(pa.array(rows))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, i, n, high, low): a task's rows of each length, and dimension i's sum in two halves."""
    held: dict[int, list] = {}
    for d, x, _ in _by_length(batches):
        n, high, low = held.get(d, (0, 0, 0))
        held[d] = (n + len(x), high + (x >> 26).sum(0), low + (x & ((1 << 26) - 1)).sum(0))
    for d, (n, high, low) in held.items():
        fill = lambda v: pa.array(np.full(d, v, np.int64))
        yield pa.RecordBatch.from_arrays([fill(d), pa.array(np.arange(d)), fill(n), pa.array(high), pa.array(low)], ["d", "i", "n", "high", "low"])


def _products(batches: Iterator[pa.RecordBatch], prepare) -> Iterator[pa.RecordBatch]:
    """(d, i, products): row i of a task's sum of products of prepared vectors."""
    held: dict[int, np.ndarray] = {}
    for d, x, _ in _by_length(batches):
        y = prepare(d, x)
        if y is not None:
            held[d] = held.get(d, 0.0) + y.T @ y
    for d, total in held.items():
        size = len(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(size, d, np.int64)), pa.array(np.arange(size)), pa.array([row.tobytes() for row in total], pa.binary())], ["d", "i", "products"])


def _added(table: pa.Table) -> pa.Table:
    rows = np.frombuffer(b"".join(table["products"].to_pylist())).reshape(table.num_rows, -1)
    return pa.table({"d": table["d"][:1], "i": table["i"][:1], "products": pa.array([rows.sum(0).tobytes()], pa.binary())})


def _matrices(fit: DataFrame, prepare) -> dict[int, np.ndarray]:
    """For each length the sum of products of the prepared vectors of the fit list."""
    shape = "d long, i long, products binary"
    added = fit.mapInArrow(lambda it: _products(it, prepare), shape).groupBy("d", "i").applyInArrow(_added, shape).toArrow()
    out: dict[int, list] = {}
    for d, i, row in sorted(zip(*(added[c].to_pylist() for c in ("d", "i", "products")), strict=True)):
        out.setdefault(d, []).append(np.frombuffer(row))
    return {d: np.array(rows) for d, rows in out.items()}


def fit(whole: DataFrame, n_components: int = 16) -> dict[int, Model]:
    """A model for each vector length among the rows (x: array of whole numbers)."""
    spark = whole.sparkSession
    once = store(whole.select("x").distinct(), "fit-list")
    sums = once.mapInArrow(_sums, "d long, i long, n long, high long, low long").groupBy("d", "i").agg(
        *(F.sum(c).alias(c) for c in ("n", "high", "low"))).orderBy("d", "i").collect()  # one row a dimension
    models: dict[int, Model] = {}
    for row in sums:
        model = models.setdefault(row["d"], Model(row["n"], [], np.zeros(0), np.zeros(0)))
        model.sums.append((row["high"] << 26) + row["low"])
    held = spark.sparkContext.broadcast(models)  # of the dimensions' size
    for d, total in _matrices(once, lambda d, x: held.value[d].centred(x)).items():
        model = models[d]
        covariance = total / model.n
        trace = float(np.trace(covariance))
        e, vectors = components(covariance, n_components)
        real = e > 1e-13 * trace if trace > 0 else np.zeros(len(e), bool)
        model.turn, model.explained = vectors[:, real] / np.sqrt(e[real]), e[real] / trace if trace > 0 else e[real]
    turned = spark.sparkContext.broadcast(models)

    def prepare(d: int, x: np.ndarray) -> np.ndarray | None:
        """Whitened vectors with a one, so that products hold their sums too."""
        model = turned.value[d]
        if not len(model.explained):
            return None
        return np.c_[model.centred(x) @ model.turn, np.ones(len(x))]

    for d, total in _matrices(once, prepare).items():
        mean = total[-1, :-1] / models[d].n
        models[d].identity_error = float(np.abs(total[:-1, :-1] / models[d].n - np.outer(mean, mean) - np.eye(len(mean))).max())
    return models


def whiten(vectors: DataFrame, n_components: int = 16, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error): arrays hold one entry a component."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("embedding"))
    kind = dict(rows.dtypes)["id"]
    whole = store(rows.where("embedding IS NOT NULL").mapInArrow(_whole, f"id {kind}, x array<long>"), "whole-vectors")
    held = spark.sparkContext.broadcast(fit(whole, n_components))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for d, x, batch in _by_length(batches):
            model = held.value[d]
            count, k = len(x), len(model.explained)
            if not k:
                continue
            out = model.centred(x) @ model.turn
            at = np.arange(count + 1) * k
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(np.full(count, model.n, np.int64)), pa.array(model.deviations(x), pa.int64()), W.ragged(out.ravel(), at, pa.float64()),
                W.ragged(np.tile(model.explained, count), at, pa.float64()), pa.array(np.full(count, model.identity_error))],
                [id_col, "n", "deviation", "whitened", "explained", "identity_error"])

    return whole.mapInArrow(run, f"`{id_col}` {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double")
