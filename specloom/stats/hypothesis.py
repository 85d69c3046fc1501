"""Intervals and tests."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import keep_groups
from ..operators.ordered import ranked_value_counts
from ..session import ship_package, store
from . import dist

SHAPIRO_ROWS = 5000


def ci_moments(df: DataFrame, key: str, value: str, groups: DataFrame) -> DataFrame:
    """H01 first half: n, mean, sample deviation for each of the listed groups (a LIMIT result)."""
    inside = keep_groups(df.filter(F.col(value).isNotNull()), groups, key, bounded=True)
    moments = inside.groupBy(key).agg(
        F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")
    )
    return groups.select(key).join(moments, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def t_interval(moments: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Bounds at 2 places; NULL for fewer than two values. The input has one row per group."""

    ship_package(moments.sparkSession)

    @F.pandas_udf("double")
    def t_score(n):
        return n.map(lambda k: dist.t_ppf(1 - alpha / 2, k - 1) if k >= 2 else None).astype("float64")

    enough = F.col("n") >= 2
    margin = F.nanvl(F.col("__t"), F.lit(None).cast("double")) * F.col("std") / F.sqrt("n")
    return (
        moments.withColumn("__t", t_score("n"))
        .withColumn("alpha", F.lit(alpha))
        .withColumn("lower", F.when(enough, F.round(F.col("mean") - margin, 2)))
        .withColumn("upper", F.when(enough, F.round(F.col("mean") + margin, 2)))
        .withColumn("mean", F.when(enough, F.round("mean", 2)))
        .withColumn("std", F.when(enough, F.round("std", 2)))
        .drop("__t")
    )


def welch_stat(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    """T and its Satterthwaite degrees of freedom, one row, from grouped moments."""
    pick = lambda level: F.when(F.col(group) == level, F.col(value).cast("double"))
    m = df.agg(
        F.count(pick(a)).alias("n_a"), F.avg(pick(a)).alias("m_a"), F.var_samp(pick(a)).alias("v_a"),
        F.count(pick(b)).alias("n_b"), F.avg(pick(b)).alias("m_b"), F.var_samp(pick(b)).alias("v_b"),
    )
    qa, qb = F.try_divide(F.col("v_a"), "n_a"), F.try_divide(F.col("v_b"), "n_b")
    return m.select(
        "n_a", "n_b",
        F.try_divide(F.col("m_a") - F.col("m_b"), F.sqrt(qa + qb)).alias("statistic"),
        F.try_divide(
            (qa + qb) ** 2, F.try_divide(qa**2, F.col("n_a") - 1) + F.try_divide(qb**2, F.col("n_b") - 1)
        ).alias("df"),
    )


def mann_whitney_stat(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    """U of the first group and the tie term, from mid-ranks of counted values."""
    both = df.filter(F.col(group).isin(a, b))
    ranked = ranked_value_counts(both, [], value, extra={"__a": F.count_if(F.col(group) == a)})
    mid = F.col("before") + (F.col("n") + 1) / 2.0
    n = F.col("n").cast("double")
    sums = ranked.agg(
        F.sum("__a").alias("n_a"), F.sum(F.col("n") - F.col("__a")).alias("n_b"),
        F.sum(F.col("__a") * mid).alias("__r"), F.sum(n * n * n - n).alias("tie_term"),
    )
    n_a = F.col("n_a").cast("double")
    return sums.select("n_a", "n_b", (F.col("__r") - n_a * (n_a + 1) / 2.0).alias("statistic"), "tie_term")


def mann_whitney_method(n_a: int, n_b: int, tie_term: float) -> str:
    """"exact" for tie-free samples with a side of at most 8 values, else "asymptotic"; whatever the other side's size."""
    return "exact" if min(n_a, n_b) <= 8 and tie_term == 0 else "asymptotic"


def mann_whitney_p(n_a: int, n_b: int, u: float, tie_term: float, method: str | None = None) -> float:
    """Two-sided p by the named method; the asymptotic one has both corrections."""
    top = max(u, n_a * n_b - u)
    if (method or mann_whitney_method(n_a, n_b, tie_term)) == "exact":
        return min(1.0, 2.0 * dist.rank_sum_exact_sf(top, n_a, n_b))
    n = n_a + n_b
    sd = math.sqrt(n_a * n_b / 12.0 * ((n + 1) - tie_term / (n * (n - 1.0))))
    if sd == 0:
        return 1.0
    return min(1.0, 2.0 * dist.normal_sf((top - n_a * n_b / 2.0 - 0.5) / sd))


def shapiro(df: DataFrame, value: str, group: str) -> DataFrame:
    """W and p per group on at most 5000 drawn values, so groups stay small."""
    known = df.filter(F.col(value).isNotNull()).select(
        F.col(group).cast("string").alias(group), F.col(value).cast("double").alias(value)
    )
    drawn = drawn_counts(known, value, group).select(group, F.explode(F.sequence(F.lit(1), "copies")).alias("copy"), value)
    ship_package(df.sparkSession)

    def test(pdf):
        import pandas as pd

        w, p = dist.shapiro_wilk(pdf[value]) if len(pdf) >= 3 else (None, None)
        return pd.DataFrame({group: [pdf[group].iloc[0]], "n": [len(pdf)], "w": [w], "p_value": [p]})

    return drawn.groupBy(group).applyInPandas(test, f"`{group}` string, n long, w double, p_value double")


def drawn_counts(known: DataFrame, value: str, group: str, size: int = SHAPIRO_ROWS) -> DataFrame:
    """How many rows of each value are drawn per group: (group, value, copies), `copies` > 0.

    A group of at most `size` rows is taken whole. Of a larger one every position
    floor(j * total / size) in value order is drawn, so each value has its share of the
    rows, no matter how often it occurs, and the draw repeats.
    """
    ranked = ranked_value_counts(known, [group], value)
    before = lambda rank: F.ceil(rank * F.lit(size) / F.col("total"))
    share = before(F.col("before") + F.col("n")) - before(F.col("before"))
    return ranked.select(
        group, value, F.when(F.col("total") <= size, F.col("n")).otherwise(share).cast("int").alias("copies")
    ).filter("copies > 0")


def two_sample(df: DataFrame, value: str, group: str, a, b) -> dict:
    """Welch when both groups look normal, else Mann-Whitney; too small is insufficient."""
    known = df.filter(F.col(value).isNotNull() & F.col(group).isin(a, b))
    welch = welch_stat(known, value, group, a, b).first()
    if welch["n_a"] < 3 or welch["n_b"] < 3:
        return {"test": "insufficient_data", "statistic": None, "p_value": None}
    normal = {r[group]: r["p_value"] for r in shapiro(known, value, group).collect()}
    out = {"shapiro_p_a": normal[str(a)], "shapiro_p_b": normal[str(b)]}
    if normal[str(a)] > 0.05 and normal[str(b)] > 0.05:
        t = welch["statistic"]
        p = dist.t_two_sided(t, welch["df"]) if t is not None else None
        return {"test": "Welch t-test", "statistic": t, "p_value": p, **out}
    u = mann_whitney_stat(known, value, group, a, b).first()
    method = mann_whitney_method(u["n_a"], u["n_b"], u["tie_term"])
    p = mann_whitney_p(u["n_a"], u["n_b"], u["statistic"], u["tie_term"], method)
    return {"test": "Mann-Whitney U", "statistic": u["statistic"], "p_value": p, "method": method, **out}


def anova_cells(df: DataFrame, y: str, factors: list[str]) -> DataFrame:
    """n, mean and within-cell sum of squares per factor cell."""
    known = df.dropna(subset=[y, *factors])
    return known.groupBy(*factors).agg(
        F.count("*").alias("n"), F.avg(y).alias("mean"),
        (F.var_pop(y) * F.count("*")).alias("ss_within"),
    )


def anova_one_way_ss(df: DataFrame, y: str, factor: str) -> DataFrame:
    """H07 sums of squares as one row, all on Spark."""
    cells = anova_cells(df, y, [factor])
    grand = cells.agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("g")).scalar()
    off = F.col("mean") - grand
    return cells.agg(
        F.count("*").alias("levels"), F.sum("n").alias("n"),
        F.sum(F.col("n") * off * off).alias("ss_between"), F.sum("ss_within").alias("ss_within"),
    )


def anova(df: DataFrame, y: str, factors: list[str]) -> list[dict]:
    """H07 (one factor) and H08 (two factors with interaction), type II.

    Returns [] when a factor has one level or no residual degrees of freedom are
    left, the form in which the caller reports insufficient data. Empty cells lower
    the rank, and with it the interaction's degrees of freedom.
    """
    if len(factors) == 1:
        return _one_way(anova_one_way_ss(df, y, factors[0]).first(), factors[0])
    return _two_way(df, y, factors)


def _levels(cells: DataFrame, factor: str) -> DataFrame:
    """(level, n, t) of one factor: rows and sum of the centred response."""
    return cells.groupBy(F.col(factor).alias("level")).agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


def _beyond(cells: DataFrame, large: str, small: str, levels: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Normal equations of the smaller factor with the larger one swept out (its Schur complement), without the diagonal.

    A level of the larger factor is one row with at most as many cells as the smaller one has levels.
    """
    k, at = len(levels), {v: i for i, v in enumerate(levels)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.column("cells").slice(start, 500)
                row = np.repeat(np.arange(len(part)), part.value_lengths().to_numpy())
                held = part.flatten()
                j = np.array([at[v] for v in held.field("level").to_pylist()], np.int64)
                n = np.zeros((len(part), k))
                n[row, j] = held.field("n").to_numpy()
                t = np.bincount(row, held.field("t").to_numpy(), len(part))
                total -= (n / n.sum(1, keepdims=True)).T @ np.c_[n, t]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "parts"])

    ship_package(cells.sparkSession)
    wide = cells.groupBy(large).agg(F.collect_list(F.struct(F.col(small).alias("level"), "n", "t")).alias("cells")).select("cells")
    added = wide.mapInArrow(run, "i long, parts array<double>").select("i", F.posexplode("parts").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((k, k + 1))
    for r in added.collect():  # the smaller factor's levels squared
        out[r["i"], r["j"]] = r["v"]
    return out[:, :k], out[:, k]


def _two_way(df: DataFrame, y: str, factors: list[str]) -> list[dict]:
    """Only totals and the smaller factor's equations reach the driver, however many levels the larger one has."""
    cells = anova_cells(df.select(F.col(y).cast("double").alias(y), *[F.col(f).cast("string").alias(f) for f in factors]), y, factors)
    cells = store(cells, "cells")
    # centred, so that the fits do not cancel large numbers
    grand = cells.agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("g")).first()["g"]
    if grand is None:
        return []
    cells = cells.withColumn("t", F.col("n") * (F.col("mean") - F.lit(grand)))
    whole = cells.agg(F.count("*").alias("cells"), F.sum("n").alias("n"), F.sum("ss_within").alias("within"), F.sum(F.col("t") * F.col("t") / F.col("n")).alias("between")).first()
    one = {f: _levels(cells, f).agg(F.count("*").alias("levels"), F.sum(F.col("t") * F.col("t") / F.col("n")).alias("explained")).first() for f in factors}
    if min(r["levels"] for r in one.values()) < 2:
        return []
    df_resid = whole["n"] - whole["cells"]
    if df_resid <= 0:
        return []
    small, large = sorted(factors, key=lambda f: one[f]["levels"])
    totals = _levels(cells, small).orderBy("level").collect()  # the smaller factor's levels
    gram, right = _beyond(cells, large, small, [r["level"] for r in totals])
    gram += np.diag([float(r["n"]) for r in totals])
    right += np.array([r["t"] for r in totals])
    scale = np.sqrt([float(r["n"]) for r in totals])
    values, vectors = np.linalg.eigh(gram / np.outer(scale, scale))
    real = values > 1e-11
    root = (vectors[:, real] / np.sqrt(values[real])).T / scale
    gain = float(((root @ right) ** 2).sum())  # what the smaller factor explains beyond the larger one
    rank_both = one[large]["levels"] + int(real.sum())
    lack = max(whole["between"] - one[large]["explained"] - gain, 0.0)
    mse = whole["within"] / df_resid
    # type II: a factor's sum is what it explains beyond the other one
    beyond = {small: gain, large: one[large]["explained"] + gain - one[small]["explained"]}
    out = [_effect(f"C({f})", max(beyond[f], 0.0), rank_both - one[other]["levels"], mse, df_resid) for f, other in (factors, factors[::-1])]
    out.append(_effect(f"C({factors[0]}):C({factors[1]})", lack, whole["cells"] - rank_both, mse, df_resid))
    out.append({"factor": "Residual", "sum_sq": whole["within"], "df": float(df_resid), "F": None, "p_value": None})
    return out


def _effect(name: str, ss: float, k: int, mse: float, df_resid: int) -> dict:
    f = ss / k / mse if k > 0 and mse > 0 else None
    return {"factor": name, "sum_sq": ss, "df": float(k), "F": f, "p_value": dist.f_sf(f, k, df_resid) if f is not None else None}


def _one_way(sums, factor: str) -> list[dict]:
    """One factor needs four numbers, however many levels it has."""
    k, df_resid = (sums["levels"] or 0) - 1, (sums["n"] or 0) - (sums["levels"] or 0)
    if k < 1 or df_resid <= 0:
        return []
    mse = sums["ss_within"] / df_resid
    return [_effect(f"C({factor})", max(sums["ss_between"], 0.0), k, mse, df_resid),
            {"factor": "Residual", "sum_sq": sums["ss_within"], "df": float(df_resid), "F": None, "p_value": None}]


def decision(p: float | None, alpha: float = 0.05) -> str:
    """Strict comparison."""
    if p is None:
        return "insufficient data"
    return "reject H₀" if p < alpha else "fail to reject H₀"


def conclusion(p: float | None, alpha: float = 0.05) -> str:
    if p is None:
        return "insufficient data"
    return f"reject H0 at α={alpha}" if p < alpha else f"fail to reject H0 at α={alpha}"
