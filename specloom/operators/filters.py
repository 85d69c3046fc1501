"""Predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FORM_FACTORS


def form_filter(value: str, col: str = "form_factor") -> Column:
    """equality against a closed list."""
    if value not in FORM_FACTORS:
        raise ValueError(f"unknown form_factor: {value!r}")
    return F.col(col) == value


def between(col: str, low, high) -> Column:
    """closed range."""
    return F.col(col).between(low, high)


def not_null(col: str) -> Column:
    """F03."""
    return F.col(col).isNotNull()


def in_list(col: str, values) -> Column:
    """values are literals, so quoting cannot break out."""
    return F.col(col).isin(*values)


def contains(col: str, text: str) -> Column:
    """LIKE '%text%'."""
    return F.col(col).contains(text)


def all_of(predicates: list[Column]) -> Column:
    """AND of the given predicates; none means everything passes."""
    return reduce(lambda a, b: a & b, predicates, F.lit(True))


def having(df: DataFrame, keys: list[str], min_count: int) -> DataFrame:
    """groups with at least so many rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def usable_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns with at least one value; one pass for all of them."""
    counts = df.agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in cols]).first()
    return [c for c in cols if counts[c]]


def complete_cases(df: DataFrame, response: str, predictors: list[str]) -> tuple[DataFrame, list[str]]:
    """drop empty predictors, then rows with any gap. Returns the frame and what was dropped."""
    usable = usable_columns(df, predictors)
    kept = df.select(response, *usable).dropna()
    return kept, [c for c in predictors if c not in usable]


def drop_all_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """rows without a single key part go."""
    return df.dropna(how="all", subset=keys)


def in_subquery(df: DataFrame, sub: DataFrame, key: str) -> DataFrame:
    """IN (subquery) as a semi join."""
    return df.join(sub.select(key), key, "left_semi")


def compare_to_scalar(df: DataFrame, col: str, scalar: Column) -> DataFrame:
    """keep rows above one aggregate of the same table, e.g. F.avg(col).

    The aggregate is a scalar subquery: a single value that Spark computes once
    and inlines, no join.
    """
    return df.filter(F.col(col) > df.agg(scalar.alias("v")).scalar())
