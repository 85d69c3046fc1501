"""Constraint checks and cleaning audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_sentinel


def check_rules(df: DataFrame, rules: dict[str, str], keys: list[str]) -> DataFrame:
    """One row per broken rule. A rule over NULL passes, as in SQL.

    All rules are tested in one pass over the table.
    """
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(F.expr(cond), F.lit(True)), F.lit(name)) for name, cond in rules.items()])
    )
    return df.select(*keys, F.explode(broken).alias("rule"))


def check_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once; keys with a NULL part never collide."""
    return df.dropna(subset=key).groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def check_not_null(df: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """One row per missing required value."""
    gaps = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]))
    return df.select(*keys, F.explode(gaps).alias("column"))


def check_fk(child: DataFrame, fk: str, parent: DataFrame, key: str = "id") -> DataFrame:
    """Children whose parent does not exist; a NULL key passes."""
    known = parent.select(F.col(key).alias(fk))
    return child.filter(F.col(fk).isNotNull()).join(known, fk, "left_anti")


def still_referenced(parent: DataFrame, child: DataFrame, fk: str, key: str = "id") -> DataFrame:
    """Parents that may not be deleted because a child points at them."""
    used = child.select(F.col(fk).alias(key))
    return parent.join(used, key, "left_semi")


def _audit(df: DataFrame, raw_cols: list[str], cleaned: str) -> tuple[Column, Column]:
    present = F.greatest(*[F.col(f"`{c}`").isNotNull() for c in raw_cols]) if len(raw_cols) > 1 else (
        F.col(f"`{raw_cols[0]}`").isNotNull()
    )
    return present, present & is_sentinel(F.col(f"`{cleaned}`"), dict(df.dtypes)[cleaned])


def fallthrough_counts(df: DataFrame, raw_cols: list[str], cleaned: str) -> DataFrame:
    """Rows, rows with raw text, rows whose raw text came to nothing."""
    present, lost = _audit(df, raw_cols, cleaned)
    return df.agg(
        F.count("*").alias("row_count"), F.count_if(present).alias("raw_present"), F.count_if(lost).alias("fall_through")
    )


def fallthrough_values(df: DataFrame, raw_cols: list[str], cleaned: str, top: int = 20) -> DataFrame:
    """The most frequent raw texts that came to nothing."""
    _, lost = _audit(df, raw_cols, cleaned)
    text = F.concat_ws(" | ", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in raw_cols])
    counts = df.filter(lost).groupBy(text.alias("raw")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("raw")).limit(top)
