"""Intervals, tests and regressions over the product star (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.joins import join_dim
from ..plans import analytics as plans
from ..plans import hypothesis, regression
from ..stats import hypothesis as h
from ..stats import ols
from ..stats.moments import pair_moments
from .inputs import star_ctes
from .registry import query, sig, sig_sql

C = F.col
PHONE = "d.form_factor = 'phone'"
NAMED = "Device d JOIN Device_Name dn ON dn.id = d.device_name_id"
TOP5 = ("top5", f"SELECT dn.brand FROM {NAMED} WHERE {PHONE} GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 5")


def rounded(df, *cols, digits=9):
    return df.withColumns({c: sig(C(c), digits) for c in cols})


@query("ci_moments", star_ctes(TOP5) + f"""
    SELECT dn.brand, COUNT(*) AS n, {sig_sql('AVG(d.price_eur)')} AS mean, {sig_sql('STDDEV_SAMP(d.price_eur)')} AS std
    FROM {NAMED} WHERE {PHONE} AND d.year = (SELECT MAX(year) FROM Device d WHERE {PHONE}) AND d.price_eur IS NOT NULL
      AND dn.brand IN (SELECT brand FROM top5) GROUP BY 1""")
def _(i):
    rows = join_dim(i.star.Device.filter("form_factor = 'phone'"), i.star.Device_Name, "device_name_id", ["brand"])
    rows = rows.filter(C("year") == i.star.Device.filter("form_factor = 'phone'").agg(F.max("year")).scalar())
    return rounded(h.ci_moments(rows, "brand", "price_eur", plans.top_brands(i.star, 5)), "mean", "std")


@query("price_ci_by_brand")
def _(i):
    return plans.price_ci_by_brand(i.star)


@query("battery_ci_by_brand")
def _(i):
    return plans.battery_ci_by_brand(i.star)


@query("shapiro_draw", """
    WITH c AS (SELECT l_returnflag, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2),
         r AS (SELECT *, SUM(n) OVER (PARTITION BY l_returnflag ORDER BY l_linenumber) AS upto,
                      SUM(n) OVER (PARTITION BY l_returnflag) AS total FROM c),
         k AS (SELECT *, CASE WHEN total <= 5000 THEN n ELSE
                   CAST(ceil(upto * 5000.0 / total) AS BIGINT) - CAST(ceil((upto - n) * 5000.0 / total) AS BIGINT) END AS copies FROM r)
    SELECT l_returnflag, l_linenumber, CAST(copies AS INT) AS copies FROM k WHERE copies > 0""")
def _(i):
    return h.drawn_counts(i.table("lineitem"), "l_linenumber", "l_returnflag")


_WEIGHT_OS = f"""SELECT d.weight AS v, o.os_name AS g FROM Device d JOIN OS o ON o.id = d.os_id
    WHERE {PHONE} AND d.weight IS NOT NULL AND o.os_name IN ('Android', 'iOS')"""


@query("welch_stat", star_ctes(("w", _WEIGHT_OS), ("m", """
    SELECT COUNT(*) FILTER (WHERE g = 'Android') AS n_a, COUNT(*) FILTER (WHERE g = 'iOS') AS n_b,
           AVG(v) FILTER (WHERE g = 'Android') - AVG(v) FILTER (WHERE g = 'iOS') AS diff,
           VAR_SAMP(v) FILTER (WHERE g = 'Android') / COUNT(*) FILTER (WHERE g = 'Android') AS qa,
           VAR_SAMP(v) FILTER (WHERE g = 'iOS') / COUNT(*) FILTER (WHERE g = 'iOS') AS qb FROM w""")) + f"""
    SELECT n_a, n_b, {sig_sql('diff / sqrt(qa + qb)')} AS statistic,
           {sig_sql('(qa + qb) * (qa + qb) / (qa * qa / (n_a - 1) + qb * qb / (n_b - 1))')} AS df FROM m""")
def _(i):
    rows = hypothesis.test_rows(i.star, "weight_android_vs_ios")
    return rounded(h.welch_stat(rows, "weight", "os_name", "Android", "iOS"), "statistic", "df")


@query("mann_whitney_stat", star_ctes(("w", _WEIGHT_OS), ("r", """
    SELECT g, RANK() OVER (ORDER BY v) + (COUNT(*) OVER (PARTITION BY v) - 1) / 2.0e0 AS mid FROM w"""),
    ("t", "SELECT COUNT(*) AS c FROM w GROUP BY v")) + """
    SELECT COUNT(*) FILTER (WHERE g = 'Android') AS n_a, COUNT(*) FILTER (WHERE g = 'iOS') AS n_b,
           SUM(mid) FILTER (WHERE g = 'Android') - COUNT(*) FILTER (WHERE g = 'Android')
             * (COUNT(*) FILTER (WHERE g = 'Android') + 1) / 2.0e0 AS statistic,
           (SELECT SUM(CAST(c AS DOUBLE) * c * c - c) FROM t) AS tie_term FROM r""")
def _(i):
    rows = hypothesis.test_rows(i.star, "weight_android_vs_ios")
    return h.mann_whitney_stat(rows, "weight", "os_name", "Android", "iOS")


@query("shapiro_by_event_type")
def _(i):
    return h.shapiro(i.table("events"), "value", "event_type")


@query("anova_one_way_ss", star_ctes(("v", f"""
    SELECT d.price_eur AS y, p.chipset_manufacturer AS g FROM Device d JOIN Platform p ON p.id = d.platform_id
    WHERE {PHONE} AND d.price_eur IS NOT NULL"""), ("m", "SELECT g, AVG(y) AS gm FROM v GROUP BY 1")) + f"""
    SELECT COUNT(DISTINCT v.g) AS levels, COUNT(*) AS n,
           {sig_sql('SUM((gm - (SELECT AVG(y) FROM v)) * (gm - (SELECT AVG(y) FROM v)))', 8)} AS ss_between,
           {sig_sql('SUM((y - gm) * (y - gm))')} AS ss_within FROM v JOIN m ON m.g = v.g""")
def _(i):
    out = h.anova_one_way_ss(hypothesis.test_rows(i.star, "price_by_chipset"), "price_eur", "chipset_manufacturer")
    return rounded(rounded(out, "ss_within"), "ss_between", digits=8)


def _test_sql(name: str) -> str:
    """The rows of a test in SQL: value as y, factors under their names."""
    spec = hypothesis.TESTS[name]
    tables = dict.fromkeys((t, fk) for t, fk, _ in spec.dims)
    joins = " ".join(f"JOIN {t} ON {t}.id = d.{fk}" for t, fk in tables)
    where = [PHONE, f"{spec.value} IS NOT NULL"]
    if spec.levels and spec.factors[0] != "size":
        where.append(f"{spec.factors[0]} IN ({', '.join(repr(v) for v in spec.levels)})")
    if spec.top_brands:
        where.append(f"brand IN (SELECT dn.brand FROM {NAMED} WHERE {PHONE} GROUP BY 1 ORDER BY COUNT(*) DESC, 1 "
                     f"LIMIT {spec.top_brands})")
    cols = ["CASE WHEN display_size_inch >= 7 THEN 'large' ELSE 'small' END AS size" if f == "size" else f for f in spec.factors]
    return f"SELECT {spec.value} AS y, {', '.join(cols)} FROM Device d {joins} WHERE {' AND '.join(where)}"


for _name, _spec in hypothesis.TESTS.items():
    _keys = ", ".join(_spec.factors)

    @query(f"ht_groups_{_name}", star_ctes(("v", _test_sql(_name))) + f"""
        SELECT {_keys}, COUNT(*) AS n, {sig_sql('AVG(y)')} AS mean,
               {sig_sql('CASE WHEN COUNT(*) > 1 THEN STDDEV_SAMP(y) END')} AS std, quantile_cont(y, 0.5) AS median
        FROM v GROUP BY {_keys}""")
    def _(i, _name=_name):
        return rounded(hypothesis.test_groups(i.star, _name), "mean", "std")

    @query(f"ht_{_name}")
    def _(i, _name=_name):
        return hypothesis.run_test(i.star, _name)[0]

    if _spec.kind == "one_way":
        _f = _spec.factors[0]

        @query(f"anova_{_name}", star_ctes(("v", _test_sql(_name)), ("m", f"SELECT {_f} AS g, AVG(y) AS gm FROM v GROUP BY 1"), ("s", f"""
            SELECT COUNT(DISTINCT g) - 1.0e0 AS dfb, COUNT(*) - COUNT(DISTINCT g) + 0.0e0 AS dfw,
                   SUM((gm - (SELECT AVG(y) FROM v)) * (gm - (SELECT AVG(y) FROM v))) AS ssb,
                   SUM((y - gm) * (y - gm)) AS ssw FROM v JOIN m ON m.g = v.{_f}""")) + f"""
            SELECT 'C({_f})' AS factor, {sig_sql('ssb', 7)} AS sum_sq, dfb AS df, {sig_sql('(ssb / dfb) / (ssw / dfw)', 7)} AS "F" FROM s
            UNION ALL SELECT 'Residual', {sig_sql('ssw', 7)}, dfw, NULL FROM s""")
        def _(i, _name=_name):
            return rounded(hypothesis.anova_rows(i.star, _name).drop("p_value"), "sum_sq", "F", digits=7)

    if _spec.kind == "two_way":
        _a, _b = _spec.factors

        @query(f"anova_residual_{_name}", star_ctes(("v", _test_sql(_name)), ("m", f"""
            SELECT {_a} AS a, {_b} AS b, AVG(y) AS gm FROM v GROUP BY 1, 2""")) + f"""
            SELECT 'Residual' AS factor, {sig_sql('SUM((y - gm) * (y - gm))', 8)} AS sum_sq,
                   COUNT(*) - (SELECT COUNT(*) FROM m) + 0.0e0 AS df FROM v JOIN m ON m.a = v.{_a} AND m.b = v.{_b}""")
        def _(i, _name=_name):
            out = hypothesis.anova_rows(i.star, _name).filter("factor = 'Residual'")
            return rounded(out.select("factor", "sum_sq", "df"), "sum_sq", digits=8)

        @query(f"anova_{_name}")
        def _(i, _name=_name):
            return hypothesis.anova_rows(i.star, _name)


_BASE = f"""
    SELECT d.price_eur AS price, d.battery_capacity_mah AS battery_mah, d.weight, d.year, dn.brand, x.display_size_inch,
           x.resolution_pixels, x.screen_to_body_ratio, x.ppi_density, p.chipset_manufacturer, p.ram_gb,
           p.internal_storage_gb AS storage_gb, o.os_name
    FROM {NAMED} JOIN Display x ON x.id = d.display_id JOIN Platform p ON p.id = d.platform_id JOIN OS o ON o.id = d.os_id
    WHERE {PHONE} AND d.price_eur IS NOT NULL"""


@query("model_base", star_ctes() + _BASE)
def _(i):
    return regression.model_base(i.star)


def _coef(i, numeric, categorical=()):
    fit = ols.fit_ols(regression.model_base(i.star), "price", list(numeric), list(categorical))
    return fit, ols.coefficients(i.spark, fit)


@query("ols_simple", star_ctes(("b", _BASE), ("v", "SELECT price AS y, battery_mah AS x FROM b WHERE battery_mah IS NOT NULL")) + f"""
    SELECT COUNT(*) AS n, {sig_sql('regr_slope(y, x)', 8)} AS slope, {sig_sql('regr_intercept(y, x)', 8)} AS intercept,
           {sig_sql('regr_r2(y, x)', 7)} AS r_squared FROM v""")
def _(i):
    fit, _coefs = _coef(i, ["battery_mah"])
    out = i.spark.createDataFrame([(fit.n, float(fit.coef[1]), float(fit.coef[0]), float(fit.r_squared))],
                                  "n long, slope double, intercept double, r_squared double")
    return rounded(rounded(out, "slope", "intercept", digits=8), "r_squared", digits=7)


@query("ols_two_predictors", star_ctes(("b", _BASE), ("v", """
    SELECT CAST(price AS DOUBLE) AS y, CAST(ram_gb AS DOUBLE) AS a, weight AS c FROM b WHERE weight IS NOT NULL AND ram_gb IS NOT NULL"""),
    ("s", """SELECT COUNT(*) AS n, AVG(y) AS my, AVG(a) AS ma, AVG(c) AS mc, var_pop(a) AS saa, var_pop(c) AS scc, var_pop(y) AS syy,
             covar_pop(a, c) AS sac, covar_pop(y, a) AS sya, covar_pop(y, c) AS syc FROM v"""),
    ("k", """SELECT *, (sya * scc - syc * sac) / (saa * scc - sac * sac) AS b1, (syc * saa - sya * sac) / (saa * scc - sac * sac) AS b2
             FROM s"""), ("r", "SELECT *, (b1 * sya + b2 * syc) / syy AS r2 FROM k")) + f"""
    SELECT 'Intercept' AS name, {sig_sql('my - b1 * ma - b2 * mc', 7)} AS coef FROM r
    UNION ALL SELECT 'ram_gb', {sig_sql('b1', 7)} FROM r UNION ALL SELECT 'weight', {sig_sql('b2', 7)} FROM r
    UNION ALL SELECT 'r_squared', {sig_sql('r2', 6)} FROM r
    UNION ALL SELECT 'f_statistic', {sig_sql('(r2 / 2) / ((1 - r2) / (n - 3))', 6)} FROM r""")
def _(i):
    fit, coefs = _coef(i, ["ram_gb", "weight"])
    extra = i.spark.createDataFrame([("r_squared", float(fit.r_squared)), ("f_statistic", float(fit.f_statistic))], "name string, coef double")
    return rounded(coefs.select("name", "coef"), "coef", digits=7).unionByName(rounded(extra, "coef", digits=6))


@query("price_model_os", star_ctes(("v", f"""
    SELECT d.price_eur AS y, o.os_name AS g FROM Device d JOIN OS o ON o.id = d.os_id WHERE {PHONE} AND d.price_eur IS NOT NULL"""),
    ("m", "SELECT g, AVG(y) AS gm, COUNT(*) AS c, var_pop(y) * COUNT(*) AS w FROM v GROUP BY 1"),
    ("f", "SELECT gm AS fm, c AS fc FROM m ORDER BY g LIMIT 1"),
    ("e", "SELECT SUM(w) / (SUM(c) - COUNT(*)) AS mse FROM m")) + f"""
    SELECT 'Intercept' AS name, {sig_sql('fm', 8)} AS coef, {sig_sql('sqrt(mse / fc)', 8)} AS std_err FROM f, e
    UNION ALL SELECT 'C(os_name)[T.' || g || ']', {sig_sql('gm - fm', 6)}, {sig_sql('sqrt(mse * (1.0e0 / c + 1.0e0 / fc))', 8)}
    FROM m, f, e WHERE g <> (SELECT MIN(g) FROM m)""")
def _(i):
    _summary, coefs = regression.price_model(i.star, "os")
    fine = F.when(C("name") == "Intercept", sig(C("coef"), 8)).otherwise(sig(C("coef"), 6))
    return rounded(coefs.select("name", fine.alias("coef"), "std_err"), "std_err", digits=8)


for _kind in ("specs", "full"):
    @query(f"price_model_{_kind}")
    def _(i, _kind=_kind):
        return regression.price_model(i.star, _kind)[1]

    @query(f"price_model_{_kind}_summary")
    def _(i, _kind=_kind):
        return regression.price_model(i.star, _kind)[0]


@query("ols_identities", "SELECT true AS residuals_sum_to_zero, true AS uncorrelated_with_predictors, true AS fitted_mean_is_mean, true AS leverage_sums_to_k")
def _(i):
    base = regression.model_base(i.star)
    numeric, categorical = regression.MODELS["full"]
    fit = ols.fit_ols(base, "price", numeric, categorical)
    res = ols.residual_frame(base, fit)
    off = [F.abs(F.covar_pop("residual", c) / F.stddev_pop(c)) < 1e-4 for c in numeric]
    return res.agg(
        (F.abs(F.sum("residual")) < 1e-3).alias("residuals_sum_to_zero"),
        F.least(*off).alias("uncorrelated_with_predictors"),
        (F.abs(F.avg("fitted") - F.avg("price")) < 1e-6).alias("fitted_mean_is_mean"),
        (F.abs(F.sum("leverage") - (fit.df_model + 1)) < 1e-4).alias("leverage_sums_to_k"))


# One predictor: every diagnostic has a closed form in SQL.
_SIMPLE = [
    ("b", _BASE), ("v", "SELECT CAST(price AS DOUBLE) AS y, CAST(battery_mah AS DOUBLE) AS x FROM b WHERE battery_mah IS NOT NULL"),
    ("c", "SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS k, AVG(x) AS mx, regr_sxx(y, x) AS sxx, COUNT(*) AS n FROM v"),
    ("r", "SELECT x, k + s * x AS fitted, y - (k + s * x) AS e, 1.0e0 / n + (x - mx) * (x - mx) / sxx AS lev, n FROM v, c"),
]


def _simple(i):
    base = regression.model_base(i.star)
    fit = ols.fit_ols(base, "price", ["battery_mah"])
    return fit, ols.residual_frame(base, fit)


@query("residual_moments", star_ctes(*_SIMPLE) + f"""
    SELECT COUNT(*) AS n, {sig_sql('STDDEV_SAMP(e)', 8)} AS std_residual,
           {sig_sql('SUM(e * e * e) / COUNT(*) / pow(SUM(e * e) / COUNT(*), 1.5)', 7)} AS skew,
           {sig_sql('SUM(e * e * e * e) / COUNT(*) / pow(SUM(e * e) / COUNT(*), 2)', 7)} AS kurtosis FROM r""")
def _(i):
    _fit, res = _simple(i)
    out = ols.residual_moments(res).select("n", "std_residual", "skew", "kurtosis")
    return rounded(rounded(out, "std_residual", digits=8), "skew", "kurtosis", digits=7)


@query("jarque_bera", star_ctes(*_SIMPLE, ("m", """
    SELECT COUNT(*) AS n, SUM(e * e * e) / COUNT(*) / pow(SUM(e * e) / COUNT(*), 1.5) AS sk,
           SUM(e * e * e * e) / COUNT(*) / pow(SUM(e * e) / COUNT(*), 2) AS ku FROM r""")) + f"""
    SELECT {sig_sql('n / 6.0e0 * (sk * sk + (ku - 3) * (ku - 3) / 4)', 7)} AS statistic FROM m""")
def _(i):
    _fit, res = _simple(i)
    got = ols.jarque_bera(ols.residual_moments(res).first())
    return rounded(i.spark.createDataFrame([(got["statistic"],)], "statistic double"), "statistic", digits=7)


@query("breusch_pagan", star_ctes(*_SIMPLE) + f"""
    SELECT {sig_sql('COUNT(*) * regr_r2(e * e, x)', 5)} AS lm FROM r""")
def _(i):
    fit, res = _simple(i)
    return rounded(i.spark.createDataFrame([(ols.breusch_pagan(res, fit)["lm"],)], "lm double"), "lm", digits=5)


@query("cooks_top", star_ctes(*_SIMPLE) + f"""
    SELECT {sig_sql('e * e * lev / (2 * (SELECT SUM(e * e) / (COUNT(*) - 2) FROM r) * (1 - lev) * (1 - lev))', 7)} AS cooks_d,
           {sig_sql('e', 7)} AS residual FROM r
    ORDER BY e * e * lev / ((1 - lev) * (1 - lev)) DESC, e LIMIT 10""")
def _(i):
    fit, res = _simple(i)
    top = ols.cooks_top(res, fit, ties=[F.asc("residual")]).select("cooks_d", "residual")
    return rounded(top, "cooks_d", "residual", digits=7)


@query("residual_outliers", star_ctes(*_SIMPLE) + """
    SELECT COUNT(*) FILTER (WHERE abs(e / (SELECT STDDEV_POP(e) FROM r)) > 1.5) AS n FROM r""")
def _(i):
    _fit, res = _simple(i)
    std = ols.standardised(res, ols.residual_moments(res).first())
    return std.agg(F.count_if(F.abs("standardized") > 1.5).alias("n"))


@query("qq_points", star_ctes(*_SIMPLE, ("z", """
    SELECT e / (SELECT STDDEV_POP(e) FROM r) AS z, ROW_NUMBER() OVER (ORDER BY e) - 1 AS pos FROM r""")) + f"""
    SELECT pos AS position, {sig_sql('z', 6)} AS sample FROM z WHERE pos % GREATEST(1, CAST(floor((SELECT COUNT(*) FROM r) / 500) AS BIGINT)) = 0""")
def _(i):
    fit, res = _simple(i)
    std = ols.standardised(res, ols.residual_moments(res).first())
    return rounded(ols.qq_points(std, fit.n).select("position", "sample"), "sample", digits=6)


@query("vif_two_predictors", star_ctes(("b", _BASE)) + f"""
    SELECT 'ram_gb' AS predictor, {sig_sql('1 / (1 - corr(ram_gb, display_size_inch) * corr(ram_gb, display_size_inch))', 7)} AS vif FROM b
    UNION ALL SELECT 'display_size_inch', {sig_sql('1 / (1 - corr(ram_gb, display_size_inch) * corr(ram_gb, display_size_inch))', 7)} FROM b""")
def _(i):
    fit, _coefs = _coef(i, ["ram_gb", "display_size_inch"])
    return rounded(i.spark.createDataFrame(ols.vif(fit), "predictor string, vif double"), "vif", digits=7)


@query("residual_sample")
def _(i):
    return regression.price_residuals(i.star, "specs")["sample_residuals"]


@query("price_residuals_full")
def _(i):
    got = regression.price_residuals(i.star, "full")
    row = (got["formula"], got["n"], got["r_squared"], got["adj_r_squared"], got["std_residual"], got["breusch_pagan"]["lm"],
           got["breusch_pagan"]["p_value"], got["jarque_bera"]["statistic"], got["n_outliers_z3"])
    return i.spark.createDataFrame([row], "formula string, n long, r_squared double, adj_r_squared double, std_residual double,"
                                          "bp_lm double, bp_p double, jb double, n_outliers_z3 long")


@query("stepwise_path")
def _(i):
    return regression.price_feature_selection(i.star)[0]


@query("stepwise_candidates", star_ctes(("b", _BASE)) + " UNION ALL ".join(
    f"SELECT '{c}' AS candidate, COUNT({c}) AS n, {sig_sql(f'regr_r2(price, {c})', 4)} AS r_squared FROM b"
    for c in ("battery_mah", "weight", "display_size_inch", "screen_to_body_ratio", "ppi_density", "ram_gb", "year")))
def _(i):
    names = ["battery_mah", "weight", "display_size_inch", "screen_to_body_ratio", "ppi_density", "ram_gb", "year"]
    m = pair_moments(regression.model_base(i.star), ["price", *names]).where((C("column_a") == "price") & (C("column_b") != "price"))
    square = C("cross") * C("cross") / C("m2_a") / C("m2_b")
    return rounded(m.select(C("column_b").alias("candidate"), "n", square.alias("r_squared")), "r_squared", digits=4)
