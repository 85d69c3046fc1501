"""Sums of products for linear models, gathered in Arrow batches and added up by Spark.

One set of rows gives three kinds of sums: products of the numeric columns (with a leading
one), each category level's count and sums of the numeric columns, and counts of pairs of
levels. That is all a model with those columns needs, and its size is the model's: the
columns squared, the levels, the pairs of levels that occur. Gaps add nothing to it.

A tally can hold several such sets side by side under a number (`who`); a stepwise search
keeps one for the rows complete in the chosen columns and one for each gapped candidate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_stored, ship_package, store

#: Level pairs a task holds before it adds them up.
BLOCK = 1_000_000


class Coder:
    """Numbers for the texts of one category, in order of appearance; -1 for NULL."""

    def __init__(self):
        self.code: dict[str, int] = {}

    def codes(self, column: pa.Array) -> np.ndarray:
        held = column.cast(pa.string()).dictionary_encode()
        known = [self.code.setdefault(v, len(self.code)) for v in held.dictionary.to_pylist()]
        return np.array([*known, -1], np.int64)[held.indices.fill_null(len(known)).to_numpy(zero_copy_only=False)]


class Sums:
    """One task's sums of one set of rows."""

    def __init__(self, width: int, categories: list[int], pairs: list[tuple[int, int]]):
        self.gram = np.zeros((width, width))
        self.levels = {c: np.zeros((0, width)) for c in categories}
        self.pairs = {p: [] for p in pairs}

    def add(self, x: np.ndarray, codes: list[np.ndarray]) -> None:
        """Rows of numeric values (a one first) and the codes of all categories."""
        self.gram += x.T @ x
        for c, held in self.levels.items():
            there = codes[c] >= 0
            code, values = codes[c][there], x[there]
            size = max(len(held), int(code.max(initial=-1)) + 1)
            grown = np.zeros((size, x.shape[1]))
            grown[: len(held)] = held
            for j in range(x.shape[1]):
                grown[:, j] += np.bincount(code, values[:, j], size)
            self.levels[c] = grown
        for (a, b), held in self.pairs.items():
            there = (codes[a] >= 0) & (codes[b] >= 0)
            held.append(np.unique(codes[a][there] << 32 | codes[b][there], return_counts=True))
            if sum(len(k) for k, _ in held) > BLOCK:
                self.pairs[a, b] = [self._joined(held)]

    @staticmethod
    def _joined(held: list) -> tuple[np.ndarray, np.ndarray]:
        if not held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return key, np.bincount(at, np.concatenate([n for _, n in held]), len(key)).astype(np.int64)

    def batches(self, who: int, coders: list[Coder], width: int) -> Iterator[pa.RecordBatch]:
        names = [np.array([*c.code, None], object) for c in coders]

        def rows(a: int, b: int, x, y, values: np.ndarray) -> pa.RecordBatch:
            wide = np.zeros((len(values), width))
            wide[:, : values.shape[1]] = values
            fill = lambda v: pa.array(np.full(len(values), v, np.int32))
            return pa.RecordBatch.from_arrays(
                [fill(who), fill(a), fill(b), pa.array(x, pa.string()), pa.array(y, pa.string()), *(pa.array(wide[:, j]) for j in range(width))],
                ["who", "a", "b", "x", "y", *(f"v{j}" for j in range(width))])

        yield rows(-1, -1, [str(i) for i in range(len(self.gram))], [""] * len(self.gram), self.gram)
        for c, held in self.levels.items():
            used = np.flatnonzero(held[:, 0] > 0)
            yield rows(c, -1, names[c][used].tolist(), [""] * len(used), held[used])
        for (a, b), held in self.pairs.items():
            key, n = self._joined(held)
            yield rows(a, b, names[a][key >> 32].tolist(), names[b][key & 0xFFFFFFFF].tolist(), n[:, None].astype(float))


@dataclass
class Table:
    """The sums of one set of rows, on the driver: levels sorted by name, pairs as level numbers."""

    gram: np.ndarray
    levels: dict[int, tuple[list[str], np.ndarray]]
    pairs: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]]

    def less(self, other: Table) -> Table:
        """These rows without those of another set over the same or fewer columns."""
        k = len(other.gram)
        gram = self.gram[:k, :k] - other.gram
        levels, kept = {}, {}
        for c, (names, values) in self.levels.items():
            left = values[:, :k].copy()
            if c in other.levels:
                at = {v: i for i, v in enumerate(names)}
                gone, minus = other.levels[c]
                left[[at[v] for v in gone]] -= minus
            stays = left[:, 0] > 0.5
            kept[c] = np.where(stays, np.cumsum(stays) - 1, -1)
            levels[c] = ([v for v, s in zip(names, stays, strict=True) if s], left[stays])
        pairs = {}
        for (a, b), (i, j, n) in self.pairs.items():
            if (a, b) in other.pairs:
                at_a, at_b = ({v: i for i, v in enumerate(self.levels[c][0])} for c in (a, b))
                oi, oj, on = other.pairs[a, b]
                to_a = np.array([at_a[v] for v in other.levels[a][0]] or [0], np.int64)
                to_b = np.array([at_b[v] for v in other.levels[b][0]] or [0], np.int64)
                key, at = np.unique(np.r_[i << 32 | j, to_a[oi] << 32 | to_b[oj]], return_inverse=True)
                n = np.bincount(at, np.r_[n, -on], len(key))
                i, j = key >> 32, key & 0xFFFFFFFF
            there = n > 0.5
            pairs[a, b] = (kept[a][i[there]], kept[b][j[there]], n[there])
        return Table(gram, levels, pairs)


def gather(df: DataFrame, numeric: list[str], categorical: list[str], shift: np.ndarray,
           sets: Callable[[np.ndarray, list[np.ndarray]], Iterator[tuple[int, np.ndarray, int]]],
           shapes: dict[int, tuple[int, list[int], list[tuple[int, int]]]]) -> DataFrame:
    """Add up the sums of one or more sets of rows.

    `sets` gives for a batch (which numeric values are known, codes of the categories) the
    sets its rows belong to, as (who, rows, number of leading numeric columns); `shapes` says for each
    set its width (columns and the leading one), its categories and its pairs of categories.
    Gaps count as `shift`, that is as zero after centring.
    """
    spark = df.sparkSession
    ship_package(spark)
    k, width = len(numeric), max(w for w, _, _ in shapes.values())
    base = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(numeric)],
                     *[F.col(f"`{c}`").cast("string").alias(f"g{i}") for i, c in enumerate(categorical)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = [Coder() for _ in categorical]
        held = {who: Sums(*shape) for who, shape in shapes.items()}
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(k)]) if k else np.zeros((batch.num_rows, 0))
            known = ~np.isnan(x)
            x = np.c_[np.ones(len(x)), np.where(known, x - shift, 0.0)]
            codes = [coder.codes(batch.column(k + i)) for i, coder in enumerate(coders)]
            for who, rows, lead in sets(known, codes):
                held[who].add(x[rows, : lead + 1], [c[rows] for c in codes])
        for who, sums in held.items():
            yield from sums.batches(who, coders, width)

    shape = "who int, a int, b int, x string, y string, " + ", ".join(f"v{j} double" for j in range(width))
    return base.mapInArrow(run, shape).groupBy("who", "a", "b", "x", "y").agg(*[F.sum(f"v{j}").alias(f"v{j}") for j in range(width)])


def read(added: DataFrame, who: int, width: int) -> Table:
    """One set's sums on the driver; its size is that of the model."""
    return _table(added.where(F.col("who") == who).toArrow(), width)


def reader(added: DataFrame, rows: float, at_once: int = 500_000) -> tuple[Callable[[int, int], Table], Callable[[], None]]:
    """A function like `read` for several sets, and one to call when all are read.

    `rows` bounds the sums' size: while it is small they are fetched in one job, else they are
    stored and fetched one set at a time.
    """
    if rows > at_once:
        stored = store(added, "sums")
        return lambda who, width: read(stored, who, width), lambda: drop_stored(stored)
    held = added.toArrow()
    return lambda who, width: _table(held.filter(pc.equal(held["who"], who)), width), lambda: None


def _table(held: pa.Table, width: int) -> Table:
    a, b = held["a"].to_numpy(), held["b"].to_numpy()
    values = np.column_stack([held[f"v{j}"].to_numpy() for j in range(width)])
    x, y = np.array(held["x"].to_pylist(), object), np.array(held["y"].to_pylist(), object)
    gram, levels, pairs = np.zeros((width, width)), {}, {}
    for i in np.flatnonzero(a < 0).tolist():
        gram[int(x[i])] = values[i]
    for c in np.unique(a[(a >= 0) & (b < 0)]).tolist():
        rows = np.flatnonzero((a == c) & (b < 0))
        rows = rows[np.argsort(x[rows])]
        levels[c] = (x[rows].tolist(), values[rows])
    at = {c: {v: i for i, v in enumerate(names)} for c, (names, _) in levels.items()}
    for p, q in sorted({(int(p), int(q)) for p, q in zip(a[b >= 0], b[b >= 0], strict=True)}):
        rows = np.flatnonzero((a == p) & (b == q))
        number = lambda c, names: np.array(list(map(at[c].__getitem__, names)), np.int64)
        pairs[p, q] = (number(p, x[rows]), number(q, y[rows]), values[rows, 0])
    return Table(gram, levels, pairs)
