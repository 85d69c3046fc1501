"""Price imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .ordered import quantiles
from .reshape import quoted


def fill_cascade(df: DataFrame, value: str = "Price_EUR", model: str = "model", brand: str = "brand",
                 year: str = "year", min_brand_year: int = 3, min_brand: int = 5) -> DataFrame:
    """I01 with its trace: the filled value, and `fill_source` saying where it came from.

    Step 1 mean of the model, step 2 median of brand and year, step 3 median of the
    brand. All three come from originally priced rows only. The table is read twice:
    once for the price counts behind the three lookups, once to be filled. The
    lookups are stored first, so Spark knows their size: while they are small the
    wide table is not shuffled at all.
    """
    known = df.filter(F.col(value).isNotNull())
    counts = store(known.groupBy(model, brand, year, value).agg(F.count("*").alias("__n")), "price-counts")
    mean = F.sum(F.col(value) * F.col("__n")) / F.sum("__n")
    by = lambda keys, name, least: quantiles(
        counts, keys, value, {name: 0.5}, weight="__n", least=least
    )
    steps = [
        ([model], counts.groupBy(model).agg(mean.alias("__by_model"))),
        ([brand, year], by([brand, year], "__by_brand_year", min_brand_year)),
        ([brand], by([brand], "__by_brand", min_brand)),
    ]
    out = df
    for keys, lookup in steps:
        out = out.join(store(lookup, "price-lookup"), keys, "left")
    source = (
        F.when(F.col(value).isNotNull(), "original")
        .when(F.col("__by_model").isNotNull(), "within_model")
        .when(F.col("__by_brand_year").isNotNull(), "brand_year")
        .when(F.col("__by_brand").isNotNull(), "brand_only")
        .otherwise("still_missing")
    )
    filled = F.coalesce(F.col(value), "__by_model", "__by_brand_year", "__by_brand")
    return out.withColumn("fill_source", source).withColumn(value, filled).select(*quoted(df.columns), "fill_source")


def impute_cascade(df: DataFrame, **names) -> DataFrame:
    """The table with gaps filled; native and filled values are not told apart."""
    return fill_cascade(df, **names).drop("fill_source")


def impute_counts(df: DataFrame, **names) -> DataFrame:
    """Rows filled per step, and rows still empty."""
    filled = fill_cascade(df, **names).filter(F.col("fill_source") != "original")
    return filled.groupBy("fill_source").agg(F.count("*").alias("n"))
