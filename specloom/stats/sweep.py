"""Stepwise search by sweeping sums of products.

Sweeping a column out of a symmetric matrix of products leaves what the other columns hold
beyond it. With the chosen columns swept out, a candidate's worth is one division: its
remaining product with the response squared, over its own remainder. The largest category is
swept first, since its block is diagonal; the others follow as one block.

Every candidate model is judged on its own complete rows. A step is one job: it adds up the
sums of the rows complete in the chosen columns, in which all remaining numeric candidates
ride along with gaps as zero, and for each candidate with gaps the sums of the rows it lacks
(or of those it has, if they are fewer). Candidates without gaps share one sweep.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_stored, store
from .gram import centres
from .tally import Table, gather, reader

#: What is left of a column, against its whole, below which it depends on those before it.
TOLERANCE = 1e-11
#: A gain in adjusted R-squared that rounding can make.
ROUNDING = 1e-12


def sweep(a: np.ndarray, block: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, int]:
    """The matrix of the remaining columns with a block swept out, and the rank of the block.

    `scale` has the square root of each column's own product before any sweep.
    """
    rest = np.setdiff1d(np.arange(len(a)), block)
    if not len(block):
        return a[np.ix_(rest, rest)], 0
    by = scale[block]
    values, vectors = np.linalg.eigh(a[np.ix_(block, block)] / np.outer(by, by))
    real = values > TOLERANCE * max(1.0, float(values.max()))
    root = (vectors[:, real] / np.sqrt(values[real])).T / by
    half = root @ a[np.ix_(block, rest)]
    return a[np.ix_(rest, rest)] - half.T @ half, int(real.sum())


@dataclass
class Swept:
    """What extra columns and the response hold beyond the model's columns, over n rows."""

    n: float
    rank: int
    total: float
    left: np.ndarray
    own: np.ndarray


def sweep_model(t: Table, numeric: list[int], categories: list[int], extra: list[int], y: int = 1) -> Swept:
    """Sweep intercept, numeric columns and categories out of the sums; `extra` columns and y stay."""
    n = float(t.gram[0, 0])
    plain = [0, *numeric]
    by_size = sorted(categories, key=lambda c: -len(t.levels[c][0]))
    others = by_size[1:]
    keep = [*extra, y]
    starts = np.cumsum([len(plain), *(len(t.levels[c][0]) for c in others)])
    size = int(starts[-1]) + len(keep)
    a = np.zeros((size, size))
    flat = np.r_[np.arange(len(plain)), np.arange(starts[-1], size)]
    source = [*plain, *keep]
    a[np.ix_(flat, flat)] = t.gram[np.ix_(source, source)]
    place = {c: int(s) for c, s in zip(others, starts[:-1], strict=True)}
    for c, s in place.items():
        values = t.levels[c][1]
        block = np.arange(s, s + len(values))
        a[block, block] = values[:, 0]
        a[np.ix_(block, flat)] = values[:, source]
        a[np.ix_(flat, block)] = values[:, source].T

    def count(p: int, q: int) -> np.ndarray:
        """Rows of each pair of levels."""
        i, j, m = t.pairs[min(p, q), max(p, q)]
        out = np.zeros((len(t.levels[min(p, q)][0]), len(t.levels[max(p, q)][0])))
        out[i, j] = m
        return out if p < q else out.T

    for p, q in combinations(others, 2):
        both = count(p, q)
        a[place[p] : place[p] + both.shape[0], place[q] : place[q] + both.shape[1]] = both
        a[place[q] : place[q] + both.shape[1], place[p] : place[p] + both.shape[0]] = both.T
    whole = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    rank = 0
    if by_size:  # a diagonal block needs no factorisation
        widest = by_size[0]
        values = t.levels[widest][1]
        across = np.zeros((len(values), size))
        across[:, flat] = values[:, source]
        for c, s in place.items():
            both = count(widest, c)
            across[:, s : s + both.shape[1]] = both
        a = a - across.T @ (across / values[:, :1])
        rank = len(values)
    left, more = sweep(a, np.arange(int(starts[-1])), whole)
    total = float(t.gram[y, y] - t.gram[0, y] ** 2 / n) if n else 0.0
    return Swept(n, rank + more, total, left, whole[int(starts[-1]) :] ** 2)


@dataclass
class Score:
    """A model's fit from four numbers."""

    n: int
    rank: int
    rss: float
    total: float

    @property
    def r_squared(self) -> float:
        return 1.0 - self.rss / self.total if self.total > 0 else math.nan

    @property
    def adj_r_squared(self) -> float:
        free = self.n - self.rank
        return 1.0 - (1.0 - self.r_squared) * (self.n - 1) / free if free > 0 else math.nan

    def information(self, cost: float) -> float:
        """-2 log-likelihood plus `cost` a parameter."""
        if self.rss <= 0:
            return math.nan
        return self.n * (math.log(2 * math.pi) + math.log(self.rss / self.n) + 1.0) + cost * self.rank


def _score(s: Swept, extra: int | None) -> Score:
    """The model itself, or with one of its extra columns."""
    rss, rank = s.left[-1, -1], s.rank
    if extra is not None and s.left[extra, extra] > TOLERANCE * s.own[extra]:
        rss, rank = rss - s.left[extra, -1] ** 2 / s.left[extra, extra], rank + 1
    return Score(round(s.n), rank, max(float(rss), 0.0), s.total)


class Search:
    """Forward selection: each step takes the candidate whose model has the highest adjusted R-squared."""

    def __init__(self, df: DataFrame, y: str, numeric: list[str], categorical: list[str]):
        self.y, self.numeric, self.categorical = y, list(numeric), list(categorical)
        used = df.select(y, *numeric, *categorical).where(F.col(f"`{y}`").isNotNull())
        self.rows = store(used, "search-rows")  # read once a step
        shift, known = centres(self.rows, [y, *numeric], categorical)
        self.shift = dict(zip([y, *numeric], shift, strict=True))
        self.total, self.known = known[y], known
        level = self.rows.agg(*[F.approx_count_distinct(f"`{c}`").alias(f"l{i}") for i, c in enumerate(categorical)]).first() if categorical else []
        self.levels = dict(zip(categorical, level, strict=True))
        self.chosen: list[str] = []

    def _gapped(self, c: str) -> bool:
        return self.known[c] < self.total

    def scores(self) -> dict[str, Score]:
        """Each remaining candidate's model with the chosen columns, in one job."""
        left = [c for c in [*self.numeric, *self.categorical] if c not in self.chosen and self.known[c]]
        if not left:
            return {}
        nums = [c for c in self.numeric if c in self.chosen]
        lead = 1 + len(nums)
        wide = [self.y, *nums, *(c for c in left if c in self.numeric)]
        cats = [c for c in self.categorical if c in self.chosen]
        groups = [*cats, *(c for c in left if c in self.categorical)]
        own = list(range(len(cats)))
        among = list(combinations(own, 2))
        with_new = [(a, g) for g in range(len(cats), len(groups)) for a in own]
        gapped = [c for c in left if self._gapped(c)]
        few = {c: 2 * self.known[c] < self.total for c in gapped}  # fewer rows have it than lack it
        shapes = {0: (1 + len(wide), list(range(len(groups))), among + with_new)}
        shapes |= {1 + i: (1 + lead, own, among) for i in range(len(gapped))}
        at_wide, at_group = {c: i for i, c in enumerate(wide)}, {c: i for i, c in enumerate(groups)}
        side = [(at_wide.get(c), at_group.get(c), few[c]) for c in gapped]

        def sets(known: np.ndarray, codes: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, int]]:
            base = known[:, :lead].all(1)
            for i in own:
                base &= codes[i] >= 0
            yield 0, np.flatnonzero(base), len(wide)
            for who, (column, group, has) in enumerate(side, 1):
                there = known[:, column] if column is not None else codes[group] >= 0
                yield who, np.flatnonzero(base & (there if has else ~there)), lead

        shift = np.array([self.shift[c] for c in wide])
        size = [1.2 * self.levels[c] + 8 for c in groups]
        bound = sum(w + sum(size[c] for c in cs) + sum(min(size[a] * size[b], self.total) for a, b in ps) for w, cs, ps in shapes.values())
        read, done = reader(gather(self.rows, wide, groups, shift, sets, shapes), bound)
        model, taken = list(range(2, 1 + lead)), own

        def judge(c: str, t: Table) -> Score:
            if not t.gram[0, 0]:
                return Score(0, 0, 0.0, 0.0)
            if c in at_wide:
                return _score(sweep_model(t, model, taken, [1 + at_wide[c]]), 0)
            return _score(sweep_model(t, model, [*taken, at_group[c]], []), None)

        base = read(0, 1 + len(wide))
        out: dict[str, Score] = {}
        plain = [c for c in left if c not in few and c in at_wide]
        if plain and base.gram[0, 0]:
            swept = sweep_model(base, model, taken, [1 + at_wide[c] for c in plain])
            out |= {c: _score(swept, i) for i, c in enumerate(plain)}
        out |= {c: judge(c, base) for c in left if c not in few and c in at_group}

        def of_gapped(who: int, c: str) -> Score:
            part = read(who, 1 + lead)
            if few[c] and not part.gram[0, 0]:
                return Score(0, 0, 0.0, 0.0)  # no row has it beside the chosen columns
            return judge(c, _own_rows(base, part, few[c], 1 + lead, taken, at_wide.get(c), at_group.get(c)))

        with ThreadPoolExecutor(4) as pool:  # small reads side by side; each candidate's sums go before the next come
            run = inheritable_thread_target(self.rows.sparkSession)(of_gapped)
            found = [pool.submit(run, who, c) for who, c in enumerate(gapped, 1)]
            out |= {c: f.result() for c, f in zip(gapped, found, strict=True)}
        done()
        return {c: out[c] for c in left if c in out}

    def steps(self) -> Iterator[tuple[str, Score]]:
        """(column, its model) until no candidate raises adjusted R-squared."""
        best = -math.inf
        while True:
            better = [(s.adj_r_squared, c, s) for c, s in self.scores().items() if s.n and s.adj_r_squared > best + ROUNDING]
            if not better:
                return
            best, taken, score = max(better, key=lambda b: b[0])  # the first of equal ones
            self.chosen.append(taken)
            yield taken, score

    def close(self) -> None:
        drop_stored(self.rows)


def _own_rows(base: Table, part: Table, has: bool, lead: int, taken: list[int], column: int | None, group: int | None) -> Table:
    """A candidate's sums over its own complete rows.

    Those of the chosen columns are `part`, or the base without it. What involves the
    candidate itself comes from the base, where its gaps count as zero.
    """
    chosen = Table(base.gram[:lead, :lead], {c: (base.levels[c][0], base.levels[c][1][:, :lead]) for c in taken},
                   {p: v for p, v in base.pairs.items() if p[0] in taken and p[1] in taken})
    rows = part if has else chosen.less(part)
    gram = np.zeros_like(base.gram)
    gram[:lead, :lead] = rows.gram
    if column is not None:
        gram[column + 1, :], gram[:, column + 1] = base.gram[column + 1, :], base.gram[:, column + 1]
    levels, number = {}, {}
    for c in taken:
        at = {v: i for i, v in enumerate(base.levels[c][0])}
        names, sums = rows.levels[c]
        old = [at[v] for v in names]
        number[c] = np.full(len(at), -1)
        number[c][old] = np.arange(len(old))
        levels[c] = (names, np.c_[sums[:, :lead], base.levels[c][1][old][:, lead:]])
    pairs = dict(rows.pairs)
    if group is not None:
        levels[group] = base.levels[group]
        pairs |= {(a, b): (number[a][i], j, m) for (a, b), (i, j, m) in base.pairs.items() if b == group and a in taken}
    return Table(gram, levels, pairs)
