"""Price models over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import form_filter
from ..operators.joins import join_dim
from ..schemas import Star
from ..session import store
from ..stats import ols

# Predictors of each model and of the stepwise search.
MODELS = {
    "specs": (
        ["battery_mah", "weight", "display_size_inch", "resolution_pixels", "screen_to_body_ratio", "ppi_density"], [],
    ),
    "os": ([], ["os_name"]),
    "full": (
        ["battery_mah", "weight", "display_size_inch", "resolution_pixels", "screen_to_body_ratio",
         "ram_gb", "storage_gb", "year"],
        ["brand", "chipset_manufacturer"],
    ),
}
STEPWISE = (
    ["battery_mah", "weight", "display_size_inch", "resolution_pixels", "screen_to_body_ratio", "ppi_density",
     "ram_gb", "storage_gb", "year"],
    ["brand", "chipset_manufacturer", "os_name"],
)


def _priced(t: Star, form_factor: str) -> DataFrame:
    rows = t.Device.filter(form_filter(form_factor) & F.col("price_eur").isNotNull())
    return rows.withColumn("price", F.col("price_eur")).withColumn("battery_mah", F.col("battery_capacity_mah"))


def _display(rows: DataFrame, t: Star) -> DataFrame:
    return join_dim(rows, t.Display, "display_id",
                    ["display_size_inch", "resolution_pixels", "screen_to_body_ratio", "ppi_density"])


def _platform(rows: DataFrame, t: Star) -> DataFrame:
    return join_dim(rows, t.Platform, "platform_id",
                    {"chipset_manufacturer": "chipset_manufacturer", "ram_gb": "ram_gb",
                     "storage_gb": "internal_storage_gb"})


def model_base(t: Star, form_factor: str = "phone", key: tuple[str, ...] = ()) -> DataFrame:
    """Every candidate predictor, rows with gaps kept; `key` adds columns that name the row."""
    rows = join_dim(_priced(t, form_factor), t.Device_Name, "device_name_id", ["brand"])
    rows = join_dim(_platform(_display(rows, t), t), t.OS, "os_id", ["os_name"])
    return rows.select(
        *key, "price", "battery_mah", "weight", "year", "brand", "display_size_inch", "resolution_pixels",
        "screen_to_body_ratio", "ppi_density", "chipset_manufacturer", "ram_gb", "storage_gb", "os_name",
    )


def model_rows(t: Star, kind: str, form_factor: str = "phone") -> DataFrame:
    """The rows a price model is fitted on: only the joins it needs."""
    rows = _priced(t, form_factor)
    if kind == "os":
        return join_dim(rows, t.OS, "os_id", ["os_name"])
    rows = _display(rows, t)
    if kind == "full":
        rows = _platform(join_dim(rows, t.Device_Name, "device_name_id", ["brand"]), t)
    return rows


def fit_price_model(t: Star, kind: str, form_factor: str = "phone") -> ols.Fit:
    """H13."""
    numeric, categorical = MODELS[kind]
    # the OS model has no minimum: it only needs complete rows
    least = 1 if kind == "os" else 10
    return ols.fit_ols(model_rows(t, kind, form_factor), "price", numeric, categorical, least)


def price_model(t: Star, kind: str, form_factor: str = "phone") -> tuple[DataFrame, DataFrame]:
    """Overall row and coefficient table."""
    fit = fit_price_model(t, kind, form_factor)
    spark = t.Device.sparkSession
    return ols.summary(spark, fit), ols.coefficients(spark, fit)


def price_residuals(t: Star, model: str = "full", form_factor: str = "phone") -> dict:
    """All residual diagnostics of a price model. Frames stay lazy, numbers are final.

    The star is joined once: the model's rows are stored, and so are their residuals, whose
    moments and outliers are observed while they are written.
    Rows carry the device id, which draws the sample and names the influential ones.
    """
    if model not in ("specs", "full"):
        return {"error": f"unknown model '{model}'; expected one of ['specs', 'full']"}
    spark = t.Device.sparkSession
    numeric, categorical = MODELS[model]
    base = store(model_base(t, form_factor, ("id",)).select("id", "price", *numeric, *categorical), "model-rows")
    fit = ols.fit_ols(base, "price", numeric, categorical)
    if fit.error:
        return {"error": fit.error, "model": model, "dropped_predictors": fit.dropped, "n": fit.n}
    res, moments = ols.stored_residuals(base, fit, ["id"])
    std = ols.standardised(res, moments)
    ties = [F.asc("id")]
    return {
        "model": model, "formula": fit.formula, "dropped_predictors": fit.dropped,
        "r_squared": fit.r_squared, "adj_r_squared": fit.adj_r_squared,
        "n": fit.n, "mean_residual": moments["mean_residual"], "std_residual": moments["std_residual"],
        "sample_residuals": ols.residual_sample(std, key=["id"]), "qq_plot": ols.qq_points(std, fit.n),
        "breusch_pagan": ols.breusch_pagan(res, fit), "jarque_bera": ols.jarque_bera(moments),
        "vif": spark.createDataFrame(ols.vif(fit), "predictor string, vif double"),
        "top_cooks_d": ols.cooks_top(res, fit, ties=ties).select("id", "cooks_d", "fitted", "residual"),
        "n_outliers_z3": moments["n_outliers"],
    }


def price_feature_selection(t: Star, form_factor: str = "phone") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The path of the search, the overall row of the model it ends with, and that model's coefficients."""
    spark = t.Device.sparkSession
    found = ols.select_predictors(model_base(t, form_factor), "price", *STEPWISE)
    final = found.final or ols.Fit("price ~", error="no predictor raises adjusted R-squared")
    return spark.createDataFrame(found.path, ols.Selection.SHAPE), ols.summary(spark, final), ols.coefficients(spark, final)
