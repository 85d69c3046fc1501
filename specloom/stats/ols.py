"""Least squares and its diagnostics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordered import every_kth
from ..operators.ranking import hash_sample
from ..session import ship_package, store
from . import dist
from .gram import Design, Sums, centres, collect_sums, design
from .sweep import Search


def _finite(v) -> float | None:
    return None if v is None or math.isnan(v) or math.isinf(v) else float(v)


@dataclass
class Fit:
    """A solved model. `error` is set instead of numbers when it cannot be fitted."""

    formula: str
    n: int = 0
    dropped: list[str] = field(default_factory=list)
    error: str | None = None
    names: list[str] = field(default_factory=list)
    coef: np.ndarray | None = None
    std_err: np.ndarray | None = None
    r_squared: float | None = None
    adj_r_squared: float | None = None
    f_statistic: float | None = None
    f_p_value: float | None = None
    aic: float | None = None
    bic: float | None = None
    df_model: int = 0
    df_resid: float = 0.0
    rss: float = 0.0
    design: Design | None = None
    inverse: np.ndarray | None = None  # (X'X)^+ in centred coordinates
    y: str = ""
    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)


def _root(gram: np.ndarray) -> np.ndarray:
    """R with R'R the pseudo-inverse of a Gram matrix; one row per rank.

    The matrix is scaled to a unit diagonal first, so predictors of very different
    size do not lose each other's digits.
    """
    scale = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    values, vectors = np.linalg.eigh(gram / np.outer(scale, scale))
    keep = values > values.max() * 1e-11
    return (vectors[:, keep] / np.sqrt(values[keep])).T / scale


def _pinv(gram: np.ndarray) -> tuple[np.ndarray, int]:
    """Pseudo-inverse and rank of a Gram matrix."""
    root = _root(gram)
    return root.T @ root, len(root)


def formula(y: str, numeric: list[str], categorical: list[str]) -> str:
    return f"{y} ~ " + " + ".join([*numeric, *[f"C({c})" for c in categorical]])


def solve(sums: Sums, y: str, numeric: list[str], categorical: list[str] = ()) -> Fit:
    """H11 on a reduced table."""
    numeric, categorical = list(numeric), list(categorical)
    fit = Fit(formula(y, numeric, categorical), y=y, numeric=numeric, categorical=categorical)
    d = design(sums, y, numeric, categorical)
    if d is None:
        fit.error = "no complete rows"
        return fit
    inv, rank = _pinv(d.gram)
    beta = inv @ d.xty
    rss = max(float(d.yty - beta @ d.xty), 0.0)
    tss = float(d.yty - d.xty[0] ** 2 / d.n)
    dfm, dfr = rank - 1, d.n - rank
    fit.n, fit.names, fit.design, fit.inverse = int(d.n), d.names, d, inv
    fit.rss, fit.df_model, fit.df_resid = rss, dfm, dfr
    # back from centred to original columns: only the intercept moves
    move = np.eye(len(beta))
    move[0, :] -= d.shift
    move[0, 0] = 1.0
    coef = move @ beta
    coef[0] += d.y_shift
    fit.coef = coef
    with np.errstate(divide="ignore", invalid="ignore"):
        sigma2 = rss / dfr if dfr > 0 else float("nan")
        fit.std_err = np.sqrt(np.maximum(np.diag(move @ inv @ move.T), 0.0) * sigma2)
        r2 = 1.0 - rss / tss if tss > 0 else float("nan")
        fit.r_squared = r2
        fit.adj_r_squared = 1.0 - (1.0 - r2) * (d.n - 1) / dfr if dfr > 0 else float("nan")
        if dfm > 0 and dfr > 0 and sigma2 > 0:
            fit.f_statistic = (tss - rss) / dfm / sigma2
            fit.f_p_value = dist.f_sf(fit.f_statistic, dfm, dfr)
        if rss > 0:
            llf = -d.n / 2.0 * (math.log(2 * math.pi) + math.log(rss / d.n) + 1.0)
            fit.aic = -2 * llf + 2 * rank
            fit.bic = -2 * llf + math.log(d.n) * rank
    return fit


def fit_ols(df: DataFrame, y: str, numeric: list[str], categorical: list[str] = (), min_rows: int = 10) -> Fit:
    """Empty predictors are dropped and reported, complete rows used, too few rows is an error."""
    numeric, categorical = list(numeric), list(categorical)
    used = df.select(y, *numeric, *categorical)
    mean, known = centres(used.filter(F.col(y).isNotNull()), [y, *numeric], categorical)
    num, cat = ([c for c in part if known[c]] for part in (numeric, categorical))
    dropped = [c for c in numeric + categorical if c not in num + cat]
    if not num and not cat:
        return Fit(formula(y, num, cat), dropped=dropped, error="no usable predictors for this form factor")
    at = {c: m for c, m in zip([y, *numeric], mean, strict=True)}
    sums = collect_sums(used, [y, *num], cat, np.array([at[c] for c in [y, *num]]))
    if sums.n < min_rows:
        return Fit(formula(y, num, cat), n=sums.n, dropped=dropped,
                   error=f"only {sums.n} rows after dropping gaps; need at least {min_rows}")
    fit = solve(sums, y, num, cat)
    fit.dropped = dropped
    return fit


def coefficients(spark, fit: Fit) -> DataFrame:
    """One row per term."""
    rows = []
    for i, name in enumerate(fit.names):
        c, se = _finite(fit.coef[i]), _finite(fit.std_err[i])
        t = c / se if c is not None and se else None
        p = dist.t_two_sided(t, fit.df_resid) if t is not None else None
        rows.append((i, name, c, se, t, p))
    return spark.createDataFrame(
        rows, "position int, name string, coef double, std_err double, t double, p_value double"
    )


def summary(spark, fit: Fit) -> DataFrame:
    """One row of overall numbers, or the error."""
    row = (
        fit.formula, fit.n, _finite(fit.r_squared), _finite(fit.adj_r_squared), _finite(fit.f_statistic),
        _finite(fit.f_p_value), list(fit.dropped), fit.error,
    )
    return spark.createDataFrame(
        [row],
        "formula string, n long, r_squared double, adj_r_squared double, f_statistic double,"
        "f_p_value double, dropped_predictors array<string>, error string",
    )


def residual_frame(df: DataFrame, fit: Fit, key: list[str] = ()) -> DataFrame:
    """Fitted value, residual and leverage for each complete row, in one narrow pass.

    With (X'X)^+ = R'R the leverage is the squared length of R x: per Arrow batch one
    product of the rows with R, to which each level of a category adds its column.
    """
    d = fit.design
    used = [fit.y, *fit.numeric, *fit.categorical]
    rows = df.select(*key, *[c for c in used if c not in key]).dropna(subset=used)
    beta, root = fit.inverse @ d.xty, _root(d.gram)
    place = {name: i for i, name in enumerate(fit.names)}
    numeric = [(c, place[c], float(d.shift[place[c]])) for c in fit.numeric]
    dummies = {c: {n[len(f"C({c})[T."):-1]: i for n, i in place.items() if n.startswith(f"C({c})[T.")} for c in fit.categorical}
    start, y = d.y_shift + float(beta[0]), fit.y
    names = [*rows.columns, "fitted", "residual", "leverage"]
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda batch, c: batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False)
        for batch in batches:
            fitted, half = np.full(batch.num_rows, start), np.tile(root[:, 0], (batch.num_rows, 1))
            for c, j, shift in numeric:
                x = number(batch, c) - shift
                fitted += beta[j] * x
                half += np.outer(x, root[:, j])
            for c, levels in dummies.items():
                coded = batch.column(c).cast(pa.string()).dictionary_encode()
                j = np.array([levels.get(v, -1) for v in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
                there = j >= 0  # the base level adds nothing
                fitted[there] += beta[j[there]]
                half[there] += root[:, j[there]].T
            leverage = np.einsum("ij,ij->i", half, half)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fitted), pa.array(number(batch, y) - fitted), pa.array(leverage)], names)

    shape = T.StructType([*rows.schema.fields, *(T.StructField(c, T.DoubleType()) for c in names[-3:])])
    return rows.mapInArrow(run, shape)


def _moments() -> list[Column]:
    return [
        F.count("residual").alias("n"), F.avg("residual").alias("mean_residual"),
        F.stddev_samp("residual").alias("std_residual"), F.stddev_pop("residual").alias("pop_std"),
        F.skewness("residual").alias("skew"), (F.kurtosis("residual") + 3.0).alias("kurtosis"),
    ]


def residual_moments(res: DataFrame) -> DataFrame:
    """N, mean, deviations, skew and (non-excess) kurtosis of the residuals."""
    return res.agg(*_moments())


def stored_residuals(df: DataFrame, fit: Fit, key: list[str] = (), outlier: float = 3.0) -> tuple[DataFrame, dict]:
    """Residuals written once, and what was observed on the way: their moments and the number of outliers.

    Residuals of a model with an intercept have mean 0 and deviation sqrt(rss / n), both
    known from the fit, so outliers are counted in the pass that writes them.
    """
    seen = Observation("residuals")
    spread = math.sqrt(fit.rss / fit.n) if fit.n else 0.0
    far = F.count_if(F.abs("residual") > F.lit(outlier * spread)) if spread > 0 else F.count_if(F.lit(False))
    res = store(residual_frame(df, fit, key).observe(seen, *_moments(), far.alias("n_outliers")), "residuals")
    return res, seen.get


def standardised(res: DataFrame, moments) -> DataFrame:
    """Residuals over their population deviation; zero when there is no spread."""
    sd = moments["pop_std"] or 0.0
    z = (F.col("residual") - F.lit(moments["mean_residual"])) / F.lit(sd) if sd > 0 else F.lit(0.0)
    return res.withColumn("standardized", z)


def residual_sample(std: DataFrame, n: int = 500, key: list[str] = ("fitted", "residual")) -> DataFrame:
    """At most n residuals for a scatter plot, the same ones each run."""
    return hash_sample(std, n, list(key)).select("fitted", "residual", "standardized")


def qq_points(std: DataFrame, n: int, max_points: int = 500) -> DataFrame:
    """Sample against normal quantiles at every k-th sorted position."""
    points = every_kth(std, "standardized", max(1, n // max_points))

    ship_package(std.sparkSession)

    # at most 2 * max_points rows; the normal quantile has no built-in function
    @F.pandas_udf("double")
    def quantile(position):
        return position.map(lambda i: dist.normal_ppf((i + 0.5) / n))

    return points.select("position", quantile("position").alias("theoretical"), F.col("standardized").alias("sample"))


def breusch_pagan(res: DataFrame, fit: Fit) -> dict:
    """Regress squared residuals on the same design."""
    squared = res.withColumn("__e2", F.col("residual") * F.col("residual"))
    aux = solve(collect_sums(squared, ["__e2", *fit.numeric], fit.categorical), "__e2", fit.numeric, fit.categorical)
    lm = aux.n * aux.r_squared if aux.r_squared is not None else float("nan")
    return {
        "lm": _finite(lm),
        "p_value": _finite(dist.chi2_sf(lm, aux.df_model)) if aux.df_model and not math.isnan(lm) else None,
        "f": _finite(aux.f_statistic), "f_p_value": _finite(aux.f_p_value),
    }


def jarque_bera(moments) -> dict:
    """H16."""
    skew, kurt, n = moments["skew"], moments["kurtosis"], moments["n"]
    if skew is None or kurt is None:
        return {"statistic": None, "p_value": None, "skew": skew, "kurtosis": kurt}
    jb = n / 6.0 * (skew**2 + (kurt - 3.0) ** 2 / 4.0)
    return {"statistic": jb, "p_value": math.exp(-jb / 2.0), "skew": skew, "kurtosis": kurt}


def vif(fit: Fit) -> list[tuple[str, float | None]]:
    """Variance inflation per predictor, from the Gram matrix alone.

    Each predictor is regressed on all other design columns; a perfect fit gives
    None.
    """
    d, out = fit.design, []
    for i, name in enumerate(fit.names):
        if name == "Intercept":
            continue
        rest = [j for j in range(len(fit.names)) if j != i]
        inv, _ = _pinv(d.gram[np.ix_(rest, rest)])
        cross = d.gram[rest, i]
        rss = d.gram[i, i] - cross @ inv @ cross
        tss = d.gram[i, i] - d.gram[0, i] ** 2 / d.n
        out.append((name, float(tss / rss) if rss > 1e-10 * tss and tss > 0 else None))
    return out


def cooks_top(res: DataFrame, fit: Fit, n: int = 10, ties: list[Column] = ()) -> DataFrame:
    """The n most influential rows by Cook's distance."""
    k = fit.df_model + 1
    mse = fit.rss / fit.df_resid
    h = F.col("leverage")
    cooks = F.try_divide(F.col("residual") ** 2 * h, F.lit(k * mse) * (1 - h) ** 2)
    return res.withColumn("cooks_d", cooks).orderBy(F.desc_nulls_last("cooks_d"), *ties).limit(n)


@dataclass
class Selection:
    """The search's path, one record a step, and the model it ends with (None: no step was taken)."""

    path: list[tuple]
    chosen: list[str]
    final: Fit | None

    #: Of a path record.
    SHAPE = ("step int, added string, formula string, n long, adj_r_squared double, r_squared double, aic double, bic double,"
             "n_predictors int")


def select_predictors(df: DataFrame, y: str, numeric: list[str], categorical: list[str]) -> Selection:
    """Forward selection by adjusted R-squared; every candidate model is judged on its own complete rows."""
    search = Search(df, y, numeric, categorical)
    term = lambda c: f"C({c})" if c in search.categorical else c
    path = []
    for added, score in search.steps():
        path.append((
            len(path) + 1, term(added), f"{y} ~ " + " + ".join(map(term, search.chosen)), score.n, _finite(score.adj_r_squared),
            _finite(score.r_squared), _finite(score.information(2.0)), _finite(score.information(math.log(score.n))), score.rank - 1))
    final = None
    if path:
        num, cat = ([c for c in part if c in search.chosen] for part in (search.numeric, search.categorical))
        final = solve(collect_sums(search.rows, [y, *num], cat), y, num, cat)
        final.formula = path[-1][2]
    search.close()
    return Selection(path, search.chosen, final)
