"""Statistics against brute force on small data and published values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from specloom.stats import dist, hypothesis, moments, ols, sweep


def test_distribution_tails():
    assert dist.t_two_sided(2.228138852, 10) == pytest.approx(0.05, abs=1e-8)
    assert dist.t_ppf(0.975, 10) == pytest.approx(2.228138852, abs=1e-7)
    assert dist.t_ppf(0.025, 1) == pytest.approx(-12.7062047, abs=1e-5)
    assert dist.f_sf(4.964602744, 1, 10) == pytest.approx(0.05, abs=1e-8)
    assert dist.chi2_sf(5.991464547, 2) == pytest.approx(0.05, abs=1e-9)
    assert dist.chi2_sf(0.5, 7) == pytest.approx(0.99940, abs=1e-4)
    assert dist.normal_sf(1.959963985) == pytest.approx(0.025, abs=1e-9)
    t, df = 1.7, 23
    assert dist.t_two_sided(t, df) == pytest.approx(dist.f_sf(t * t, 1, df), rel=1e-10)


def test_shapiro_wilk():
    # body weights of 11 men, the worked example of the original 1965 paper
    w, p = dist.shapiro_wilk([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236])
    assert w == pytest.approx(0.79, abs=0.01) and p < 0.02
    rng = np.random.default_rng(1)
    assert dist.shapiro_wilk(rng.normal(size=500))[1] > 0.05
    assert dist.shapiro_wilk(rng.exponential(size=500))[1] < 1e-6


def test_rank_sum_exact_by_enumeration():
    from itertools import combinations

    n1, n2 = 4, 5
    us = [sum(c) - n1 * (n1 - 1) // 2 for c in combinations(range(n1 + n2), n1)]
    for u in range(n1 * n2 + 1):
        assert dist.rank_sum_exact_sf(u, n1, n2) == pytest.approx(sum(x >= u for x in us) / len(us))


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(7)
    n = 400
    a, b = rng.normal(5000, 900, n), rng.normal(0, 1, n)
    g = rng.choice(["p", "q", "r"], n, p=[0.6, 0.3, 0.1])
    s = rng.choice(["x", "y"], n)
    y = 10 + 0.02 * a - 3 * b + np.where(g == "q", 4.0, 0.0) + np.where(s == "y", 2.0, 0) + rng.normal(0, 2, n)
    gap = rng.random(n) < 0.2
    rows = [(float(y[i]), float(a[i]), None if gap[i] else float(b[i]), str(g[i]), str(s[i])) for i in range(n)]
    return spark.createDataFrame(rows, "y double, a double, b double, g string, s string"), rows


def design(rows, numeric, cats):
    rows = [r for r in rows if all(r[{"y": 0, "a": 1, "b": 2, "g": 3, "s": 4}[c]] is not None for c in ["y", *numeric, *cats])]
    at = {"a": 1, "b": 2, "g": 3, "s": 4}
    cols = [np.ones(len(rows))]
    for c in cats:
        for level in sorted({r[at[c]] for r in rows})[1:]:
            cols.append(np.array([r[at[c]] == level for r in rows], float))
    cols += [np.array([r[at[c]] for r in rows]) for c in numeric]
    return np.column_stack(cols), np.array([r[0] for r in rows])


def test_ols_against_lstsq(spark, sample):
    df, rows = sample
    fit = ols.fit_ols(df, "y", ["a", "b"], ["g", "s"])
    x, y = design(rows, ["a", "b"], ["g", "s"])
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    resid = y - x @ beta
    n, k = x.shape
    mse = resid @ resid / (n - k)
    se = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * mse)
    assert fit.names == ["Intercept", "C(g)[T.q]", "C(g)[T.r]", "C(s)[T.y]", "a", "b"]
    assert fit.n == n and fit.df_resid == n - k
    np.testing.assert_allclose(fit.coef, beta, rtol=1e-8)
    np.testing.assert_allclose(fit.std_err, se, rtol=1e-8)
    assert fit.r_squared == pytest.approx(1 - resid @ resid / ((y - y.mean()) @ (y - y.mean())))
    table = {r.name: r for r in ols.coefficients(spark, fit).collect()}
    assert table["a"].p_value < 1e-10

    res = ols.residual_frame(df, fit)
    hat = np.diag(x @ np.linalg.inv(x.T @ x) @ x.T)
    cooks = np.sort(resid**2 * hat / (k * mse * (1 - hat) ** 2))[::-1][:10]
    got = [r.cooks_d for r in ols.cooks_top(res, fit).collect()]
    np.testing.assert_allclose(got, cooks, rtol=1e-6)
    bp = ols.breusch_pagan(res, fit)
    e2 = resid**2
    g2, *_ = np.linalg.lstsq(x, e2, rcond=None)
    lm = n * (1 - ((e2 - x @ g2) ** 2).sum() / ((e2 - e2.mean()) ** 2).sum())
    assert bp["lm"] == pytest.approx(lm, rel=1e-6) and 0 <= bp["p_value"] <= 1
    others = np.delete(x, 4, axis=1)
    fitted = others @ np.linalg.lstsq(others, x[:, 4], rcond=None)[0]
    want = ((x[:, 4] - x[:, 4].mean()) ** 2).sum() / ((x[:, 4] - fitted) ** 2).sum()
    assert dict(ols.vif(fit))["a"] == pytest.approx(want, rel=1e-6)


def test_ols_degenerate(spark, sample):
    df, _rows = sample
    df = df.withColumn("twice", F.col("a") * 2).withColumn("empty", F.lit(None).cast("double"))
    fit = ols.fit_ols(df, "y", ["a", "twice", "empty"])
    assert fit.dropped == ["empty"] and fit.df_model == 1
    assert fit.r_squared == pytest.approx(ols.fit_ols(df, "y", ["a"]).r_squared, rel=1e-9)
    assert dict(ols.vif(fit))["a"] is None
    assert "need at least" in ols.fit_ols(df.limit(5), "y", ["a"]).error
    assert "no usable" in ols.fit_ols(df, "y", ["empty"]).error
    assert [r.error for r in ols.summary(spark, ols.fit_ols(df, "y", ["empty"])).collect()] != [None]


def score(x, y):
    """Adjusted R-squared, R-squared and rank of a dense design."""
    beta, _, rank, _ = np.linalg.lstsq(x, y, rcond=1e-9)
    left, off = y - x @ beta, y - y.mean()
    r2 = 1 - left @ left / (off @ off)
    return 1 - (1 - r2) * (len(y) - 1) / (len(y) - rank), r2, int(rank)


def by_hand(frame, numeric, cats):
    """Forward selection on dense designs, each on its own complete rows."""
    chosen, path, best = [], [], -math.inf
    while True:
        tried = []
        for c in [*numeric, *cats]:
            if c in chosen:
                continue
            rows = frame.dropna(subset=["y", *chosen, c])
            cols = [np.ones(len(rows))]
            for v in [*chosen, c]:
                cols += [rows[v] - rows[v].mean()] if v in numeric else [(rows[v] == lv).astype(float) for lv in sorted(rows[v].unique())[1:]]
            if len(rows):
                tried.append((c, len(rows), *score(np.column_stack(cols), rows["y"].to_numpy())))
        tried = [t for t in tried if t[2] > best + sweep.ROUNDING]
        if not tried:
            return path
        top = max(tried, key=lambda t: t[2])
        best = top[2]
        chosen.append(top[0])
        path.append(top)


def test_stepwise(spark, sample):
    df, rows = sample
    found = ols.select_predictors(df, "y", ["a", "b"], ["g", "s"])
    adj = [p[4] for p in found.path]
    assert found.path[0][1] == "a" and adj == sorted(adj)
    x, y = design(rows, ["a"], [])
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    rss = ((y - x @ beta) ** 2).sum()
    n = len(y)
    aic = n * math.log(2 * math.pi) + n * math.log(rss / n) + n + 2 * 2
    assert found.path[0][6] == pytest.approx(aic)
    whole = ols.fit_ols(df, "y", [c for c in ("a", "b") if c in found.chosen], [c for c in ("g", "s") if c in found.chosen])
    assert found.final.n == whole.n == found.path[-1][3] and found.final.r_squared == pytest.approx(found.path[-1][5], rel=1e-9)
    np.testing.assert_allclose(found.final.coef, whole.coef, rtol=1e-8)
    assert ols.summary(spark, found.final).first().formula == found.path[-1][2]


@pytest.mark.parametrize("seed", [1, 2])
def test_stepwise_of_gapped_columns_and_many_levels(spark, seed):
    """Gaps in every column, from few to nearly all; copies and sums of columns; categories with many and nested levels."""
    import pandas as pd

    rng = np.random.default_rng(seed)
    n = 900
    data = {f"x{i}": rng.normal(100 * i, 1 + i, n) for i in range(7)}
    data["copy"] = data["x1"] * 3 + 5
    g = rng.integers(0, 60, n)
    data |= {"many": [f"m{v:02d}" for v in g], "nested": [f"k{v % 7}" for v in g], "few": rng.choice(["u", "v", "w"], n)}
    data["y"] = 1000 + 2 * data["x1"] - data["x4"] + np.array([rng.normal() * 3 for _ in range(60)])[g] + 4 * (data["few"] == "v") + rng.normal(0, 2, n)
    frame = pd.DataFrame(data)
    for k, (c, share) in enumerate(zip(["x0", "x1", "x2", "x3", "x5", "many", "few", "y"], [0.1, 0.3, 0.7, 0.97, 0.02, 0.2, 0.6, 0.05], strict=True)):
        frame.loc[np.random.default_rng([seed, k]).random(n) < share, c] = None
    frame["empty"] = None
    numeric, cats = [*(f"x{i}" for i in range(7)), "copy", "empty"], ["many", "nested", "few"]
    frame = frame[["y", *numeric, *cats]].astype({c: float for c in ["y", *numeric]})
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join([f"{c} double" for c in ["y", *numeric]] + [f"{c} string" for c in cats]))
    want = by_hand(frame.dropna(axis=1, how="all"), [c for c in numeric if c != "empty"], cats)
    found = ols.select_predictors(df, "y", numeric, cats)
    assert [(p[1].removeprefix("C(").rstrip(")"), p[3], p[8]) for p in found.path] == [(c, n, rank - 1) for c, n, _, _, rank in want]
    np.testing.assert_allclose([p[4] for p in found.path], [w[2] for w in want], rtol=1e-8)
    np.testing.assert_allclose([p[5] for p in found.path], [w[3] for w in want], rtol=1e-8)


def test_stepwise_without_a_step(spark):
    nothing = spark.createDataFrame([], "y double, a double, g string")
    assert ols.select_predictors(nothing, "y", ["a"], ["g"]) == ols.Selection([], [], None)
    flat = spark.createDataFrame([(1.0, 2.0, "p"), (1.0, 3.0, "q")], "y double, a double, g string")
    assert ols.select_predictors(flat, "y", ["a"], ["g"]).path == []


def test_sweep_leaves_what_is_beyond():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(50, 5))
    x = np.c_[x, x[:, 0] + x[:, 1]]
    a = x.T @ x
    left, rank = sweep.sweep(a, np.array([0, 1, 5]), np.sqrt(np.diag(a)))
    beyond = x[:, 2:5] - x[:, :2] @ np.linalg.lstsq(x[:, :2], x[:, 2:5], rcond=None)[0]
    assert rank == 2
    np.testing.assert_allclose(left, beyond.T @ beyond, atol=1e-10)


def test_pairwise_correlation(sample):
    df, rows = sample
    wide = df.withColumn("c", F.lit(1.0)).withColumn("e", F.lit(None).cast("double"))
    r = {(q.column_a, q.column_b): (q.n, q.r) for q in moments.correlation(moments.pair_moments(wide, ["y", "a", "b", "c", "e"])).collect()}
    full = [(q[0], q[2]) for q in rows if q[2] is not None]
    assert len(r) == 25
    assert r["y", "b"][0] == len(full) and r["y", "b"][1] == pytest.approx(np.corrcoef(np.array(full).T)[0, 1])
    assert r["a", "c"][1] is None and r["a", "a"][1] == pytest.approx(1.0) and r["a", "e"] == (0, None)


def test_moments_of_gapped_columns(spark):
    """Every pair over its own rows, values far from zero, a column constant where the other is known, many partitions."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 6)) * [1, 1e-3, 1e6, 5, 1, 1] + [1e9, 5, 0, -3, 7, 0]
    x[:, 1] += x[:, 3] * 1e-3
    x[rng.random(x.shape) < [0.0, 0.3, 0.5, 0.9, 0.1, 0.2]] = np.nan
    x[~np.isnan(x[:, 3]), 4] = 0.1  # constant beside column 3
    cols = [f"v {i}" for i in range(6)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in x], ", ".join(f"`{c}` double" for c in cols)).repartition(7)
    got = {(q.column_a, q.column_b): q for q in moments.pair_moments(df, cols).collect()}
    r = {(q.column_a, q.column_b): q.r for q in moments.correlation(moments.pair_moments(df, cols)).collect()}
    for i in range(6):
        for j in range(6):
            both = x[~np.isnan(x[:, i]) & ~np.isnan(x[:, j])]
            a, b, q = both[:, i] - both[:, i].mean(), both[:, j] - both[:, j].mean(), got[cols[i], cols[j]]
            assert q.n == len(both) and q.mean_a == pytest.approx(both[:, i].mean(), rel=1e-14)
            assert q.m2_a == pytest.approx(a @ a, rel=1e-6, abs=1e-12) and q.cross == pytest.approx(a @ b, rel=1e-6, abs=1e-6 * math.sqrt(a @ a * (b @ b)) + 1e-12)
            if {i, j} == {3, 4}:
                assert r[cols[i], cols[j]] is None
            else:
                assert r[cols[i], cols[j]] == pytest.approx(np.corrcoef(both[:, i], both[:, j])[0, 1], abs=1e-6)
    assert {q.n for q in moments.pair_moments(df.limit(0), cols).collect()} == {0}


def rss(x, y):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    return float(((y - x @ beta) ** 2).sum())


def test_two_way_anova_type_two(sample):
    df, rows = sample
    got = {r["factor"]: r for r in hypothesis.anova(df, "y", ["g", "s"])}
    xg, y = design(rows, [], ["g"])
    xs, _ = design(rows, [], ["s"])
    xgs, _ = design(rows, [], ["g", "s"])
    inter = np.column_stack([xgs, xgs[:, 1] * xgs[:, 3], xgs[:, 2] * xgs[:, 3]])
    full = rss(inter, y)
    assert got["C(g)"]["sum_sq"] == pytest.approx(rss(xs, y) - rss(xgs, y), rel=1e-7)
    assert got["C(s)"]["sum_sq"] == pytest.approx(rss(xg, y) - rss(xgs, y), rel=1e-7)
    assert got["C(g):C(s)"]["sum_sq"] == pytest.approx(rss(xgs, y) - full, rel=1e-6)
    assert got["Residual"]["sum_sq"] == pytest.approx(full) and got["Residual"]["df"] == len(y) - 6
    assert (got["C(g)"]["df"], got["C(g):C(s)"]["df"]) == (2.0, 2.0)


@pytest.mark.parametrize("order", [("big", "few"), ("few", "big")])
def test_two_way_anova_with_many_levels_and_empty_cells(spark, order):
    rng = np.random.default_rng(6)
    n = 900
    big, few = rng.integers(0, 120, n), rng.choice([0, 1, 2, 3, 4], n, p=[0.5, 0.3, 0.1, 0.07, 0.03])
    few[big >= 110] = 4  # levels that occur together only
    y = 1e6 + rng.normal(size=120)[big] + 0.5 * few + rng.normal(size=n)
    df = spark.createDataFrame([(float(v), f"b{b}", int(f)) for v, b, f in zip(y, big, few)], "y double, big string, few int")
    got = {r["factor"]: r for r in hypothesis.anova(df, "y", list(order))}
    dummy = lambda v: (v[:, None] == np.unique(v)).astype(float)
    both = np.column_stack([dummy(big), dummy(few)])
    cell = dummy(big * 10 + few)
    c = y - y.mean()
    full, rank = rss(cell, c), np.linalg.matrix_rank(both)
    assert got["C(big)"]["sum_sq"] == pytest.approx(rss(dummy(few), c) - rss(both, c), rel=1e-8)
    assert got["C(few)"]["sum_sq"] == pytest.approx(rss(dummy(big), c) - rss(both, c), rel=1e-8)
    assert got["C(big):C(few)" if order[0] == "big" else "C(few):C(big)"]["sum_sq"] == pytest.approx(rss(both, c) - full, rel=1e-8)
    assert got["Residual"]["sum_sq"] == pytest.approx(full) and got["Residual"]["df"] == n - cell.shape[1]
    assert (got["C(big)"]["df"], got["C(few)"]["df"]) == (rank - 5, rank - len(np.unique(big)))


def test_rank_sums_without_a_table(monkeypatch):
    """The inverted generating function against all probabilities, and its memory against a lopsided pair of sizes."""
    import tracemalloc

    for a, b in ((1, 9), (2, 5), (2, 6), (3, 4), (3, 7), (5, 4), (6, 6), (3, 50), (8, 9)):
        for u in np.arange(0, a * b + 1.5, 0.5):
            assert abs(dist.rank_sum_exact_sf(u, a, b) - dist.rank_sum_inverted_sf(u, a, b)) < 1e-12
    tracemalloc.start()
    far = dist.rank_sum_exact_sf(8 * 10**8 * 0.6, 8, 10**8)
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()
    n = 8 * 10**8
    normal = dist.normal_sf((0.6 * n - n / 2) / math.sqrt(n * (10**8 + 9) / 12))
    assert far == pytest.approx(normal, abs=5e-3)
    monkeypatch.setattr(dist, "TABLE", 1 << 30)
    for a, b in ((3, 40_000), (8, 30_000)):
        assert abs(dist.rank_sum_exact_sf(0.7 * a * b, a, b) - dist.rank_sum_inverted_sf(0.7 * a * b, a, b)) < 1e-12


def test_residuals_are_observed_as_they_are_written(sample):
    df, _rows = sample
    fit = ols.fit_ols(df, "y", ["a", "b"], ["g", "s"])
    res, seen = ols.stored_residuals(df, fit, outlier=1.5)
    moments_ = ols.residual_moments(res).first()
    assert all(seen[c] == pytest.approx(moments_[c], abs=1e-9) for c in ("n", "mean_residual", "std_residual", "pop_std", "skew", "kurtosis"))
    std = ols.standardised(res, seen)
    assert seen["n_outliers"] == std.filter(F.abs("standardized") > 1.5).count() > 0
    assert res.agg(F.sum("leverage")).first()[0] == pytest.approx(fit.df_model + 1)


def test_one_way_anova_two_levels_is_t_squared(sample):
    df, rows = sample
    table = hypothesis.anova(df, "y", ["s"])
    x = np.array([r[0] for r in rows if r[4] == "x"])
    y = np.array([r[0] for r in rows if r[4] == "y"])
    sp = (((x - x.mean()) ** 2).sum() + ((y - y.mean()) ** 2).sum()) / (len(x) + len(y) - 2)
    t = (x.mean() - y.mean()) / math.sqrt(sp * (1 / len(x) + 1 / len(y)))
    assert table[0]["F"] == pytest.approx(t * t)
    assert hypothesis.anova(df.filter("s = 'x'"), "y", ["s"]) == []


def test_two_sample_switch(spark):
    rng = np.random.default_rng(3)
    normal = [("a", float(v)) for v in rng.normal(10, 2, 200)] + [("b", float(v)) for v in rng.normal(12, 2, 200)]
    got = hypothesis.two_sample(spark.createDataFrame(normal, "g string, v double"), "v", "g", "a", "b")
    assert got["test"] == "Welch t-test" and got["p_value"] < 1e-6 and got["statistic"] < 0
    skewed = [("a", float(v)) for v in rng.exponential(1, 200)] + [("b", float(v)) for v in rng.exponential(1, 200)]
    df = spark.createDataFrame(skewed, "g string, v double")
    got = hypothesis.two_sample(df, "v", "g", "a", "b")
    a, b = [v for g, v in skewed if g == "a"], [v for g, v in skewed if g == "b"]
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert got["test"] == "Mann-Whitney U" and got["statistic"] == u and 0 < got["p_value"] <= 1
    few = spark.createDataFrame(normal[:2] + normal[-5:], "g string, v double")
    assert hypothesis.two_sample(few, "v", "g", "a", "b")["test"] == "insufficient_data"
    assert hypothesis.decision(None) == "insufficient data" and hypothesis.decision(0.05) == "fail to reject H₀"


def test_mann_whitney_ties(spark):
    data = [("a", 1.0), ("a", 2.0), ("a", 2.0), ("b", 2.0), ("b", 3.0), ("b", 3.0), ("b", 3.0)]
    row = hypothesis.mann_whitney_stat(spark.createDataFrame(data, "g string, v double"), "v", "g", "a", "b").first()
    assert (row.n_a, row.n_b, row.statistic, row.tie_term) == (3, 4, 1.0, 48.0)


def test_t_interval(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4)] + [("b", 5.0)], "g string, v double")
    groups = spark.createDataFrame([("a",), ("b",), ("c",)], "g string")
    got = {r.g: r for r in hypothesis.t_interval(hypothesis.ci_moments(df, "g", "v", groups)).collect()}
    half = dist.t_ppf(0.975, 3) * np.std([1, 2, 3, 4], ddof=1) / 2
    assert got["a"].lower == pytest.approx(2.5 - half, abs=0.006) and got["a"].upper == pytest.approx(2.5 + half, abs=0.006)
    assert (got["b"].n, got["b"].mean, got["b"].lower) == (1, None, None) and got["c"].n == 0


def test_exact_rank_sum_counts_all_arrangements():
    from itertools import combinations

    for a, b in ((1, 1), (2, 3), (3, 4), (5, 2)):
        sums = [sum(c) - min(a, b) * (min(a, b) - 1) / 2 for c in combinations(range(a + b), min(a, b))]
        for u in range(a * b + 1):
            assert abs(dist.rank_sum_exact_sf(u, a, b) - sum(s >= u for s in sums) / len(sums)) < 1e-12
    assert hypothesis.mann_whitney_method(8, 10**6, 0) == "exact"
    assert 0 < dist.rank_sum_exact_sf(8 * 20_000 // 2, 8, 20_000) < 1


def test_draw_keeps_proportions(spark):
    df = spark.range(105_000).selectExpr("'g' AS g", "CASE WHEN id < 5000 THEN 1.0 ELSE 2.0 END AS v")
    got = {r.v: r.copies for r in hypothesis.drawn_counts(df, "v", "g").collect()}
    assert sum(got.values()) == 5000 and abs(got[1.0] - 5000 * 5000 / 105_000) < 1
