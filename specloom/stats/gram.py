"""Sums of products over complete rows, and the design matrices made from them.

Rows shrink to the sums a model needs (`tally`): products of the numeric columns, level
totals and level-pair counts of the categories. The driver holds the model's own size and
nothing that grows with rows or gaps.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .tally import Table, gather, read


@dataclass
class Sums:
    """Sums over the rows complete in all columns; numeric values are centred on `shift`."""

    numeric: list[str]
    categorical: list[str]
    shift: np.ndarray
    table: Table

    @property
    def n(self) -> int:
        return round(float(self.table.gram[0, 0]))


def centres(df: DataFrame, numeric: list[str], categorical: list[str] = ()) -> tuple[np.ndarray, dict[str, int]]:
    """Means of the numeric columns (0 where nothing is known) and how often each column is known, in one pass."""
    cols = [*numeric, *categorical]
    mean = [F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(numeric)]
    row = df.agg(*mean, *[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(cols)]).first()
    return np.array([row[f"m{i}"] or 0.0 for i in range(len(numeric))]), {c: row[f"n{i}"] for i, c in enumerate(cols)}


def collect_sums(df: DataFrame, numeric: list[str], categorical: list[str] = (), shift: np.ndarray | None = None) -> Sums:
    """All sums over the rows complete in the columns; `shift` saves the pass for the means."""
    numeric, categorical = list(numeric), list(categorical)
    whole = df.dropna(subset=[*numeric, *categorical])
    if shift is None:
        shift, _ = centres(whole, numeric)
    width, cats = 1 + len(numeric), list(range(len(categorical)))
    shapes = {0: (width, cats, list(combinations(cats, 2)))}
    added = gather(whole, numeric, categorical, shift, lambda known, codes: iter([(0, slice(None), width - 1)]), shapes)
    if categorical:
        added = store(added, "sums")
    return Sums(numeric, categorical, shift, read(added, 0, width))


@dataclass
class Design:
    """Gram matrix of [1, dummies, centred numerics] and its products with the response."""

    names: list[str]
    gram: np.ndarray
    xty: np.ndarray
    yty: float
    n: float
    y_shift: float
    shift: np.ndarray  # per design column; 0 for intercept and dummies


def design(sums: Sums, y: str, numeric: list[str], categorical: list[str] = ()) -> Design | None:
    """Gram matrix over the rows of the sums, for y and some or all of their columns.

    Categories use treatment coding with the alphabetically first level as base.
    """
    t = sums.table
    n = float(t.gram[0, 0])
    if n == 0:
        return None
    at = {c: 1 + i for i, c in enumerate(sums.numeric)}
    xi, yi = [at[c] for c in numeric], at[y]
    names, first = ["Intercept"], {}
    for c in categorical:
        g = sums.categorical.index(c)
        first[g] = len(names)
        names += [f"C({c})[T.{level}]" for level in t.levels[g][0][1:]]
    k = len(names) + len(numeric)
    gram, xty = np.zeros((k, k)), np.zeros(k)
    nums = slice(len(names), k)
    gram[0, 0], gram[0, nums], gram[nums, nums] = n, t.gram[0, xi], t.gram[np.ix_(xi, xi)]
    xty[0], xty[nums] = t.gram[0, yi], t.gram[xi, yi]
    for g, start in first.items():
        values = t.levels[g][1][1:]
        block = np.arange(start, start + len(values))
        gram[0, block] = gram[block, block] = values[:, 0]
        gram[block, nums] = values[:, xi]
        xty[block] = values[:, yi]
    for (a, b), (i, j, count) in t.pairs.items():
        if a in first and b in first:
            there = (i > 0) & (j > 0)
            gram[first[a] + i[there] - 1, first[b] + j[there] - 1] = count[there]
            gram[first[b] + j[there] - 1, first[a] + i[there] - 1] = count[there]
    gram[1:, 0] = gram[0, 1:]
    gram[nums, 1 : nums.start] = gram[1 : nums.start, nums].T
    shift = np.zeros(k)
    shift[nums] = sums.shift[[i - 1 for i in xi]]
    return Design([*names, *numeric], gram, xty, float(t.gram[yi, yi]), n, float(sums.shift[yi - 1]), shift)
