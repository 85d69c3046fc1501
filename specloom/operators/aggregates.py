"""Grouped measures (A12-A21). Everything here combines before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import quantiles, ranked_value_counts


def resolve_year(df: DataFrame, year: int | None = None, col: str = "year") -> DataFrame:
    """The given year, else the latest, as one row."""
    value = F.max(col) if year is None else F.lit(int(year))
    return df.agg(value.alias(col))


def histogram(df: DataFrame, value: str, bins: int = 20, keys: list[str] = ()) -> DataFrame:
    """Equi-width bins between the smallest and largest value; the top edge is in the last bin."""
    keys = list(keys)
    known = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    if keys:
        edges = known.groupBy(*keys).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
        binned = known.join(edges, keys)
    else:
        edge = known.agg(F.struct(F.min("__v").alias("lo"), F.max("__v").alias("hi")).alias("e")).scalar()
        binned = (
            known.withColumn("__e", edge).withColumn("__lo", F.col("__e.lo"))
            .withColumn("__hi", F.col("__e.hi"))
        )
    width = (F.col("__hi") - F.col("__lo")) / bins
    raw = F.floor(F.try_divide(F.col("__v") - F.col("__lo"), width))
    slot = F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1)).cast("int")
    return (
        binned.groupBy(*keys, slot.alias("bin"), "__lo", "__hi")
        .agg(F.count("*").alias("n"))
        .select(
            *keys, "bin",
            (F.col("__lo") + F.col("bin") * width).alias("bin_start"),
            (F.col("__lo") + (F.col("bin") + 1) * width).alias("bin_end"),
            "n",
        )
    )


def quartiles(df: DataFrame, value: str, keys: list[str] = ()) -> DataFrame:
    """Exact 25, 50 and 75 percent points per key."""
    return quantiles(df, list(keys), value, {"q1": 0.25, "median": 0.5, "q3": 0.75})


def top_groups(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n most frequent values, ties by name."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(key)).limit(n)


def group_summary(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """N, mean, sample deviation (NULL for one row), exact median."""
    known = df.filter(F.col(value).isNotNull())
    spread = F.when(F.count(value) > 1, F.stddev_samp(value))
    moments = known.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg(value).alias("mean"), spread.alias("std")
    )
    middle = quantiles(known, keys, value, {"median": 0.5})
    on = [F.col(f"m.{k}").eqNullSafe(F.col(f"q.{k}")) for k in keys]
    return moments.alias("m").join(middle.alias("q"), on).select("m.*", "q.median")


def count_where(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    """A16."""
    return df.filter(condition).agg(F.count("*").alias(name))


def value_counts(df: DataFrame, col: str, top: int | None = 20) -> DataFrame:
    """Frequency of each value, NULL included, most frequent first."""
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    return counts if top is None else counts.orderBy(F.desc("n"), F.asc_nulls_last(col)).limit(top)


def miss_counts(df: DataFrame, raw: Column, parsed: Column) -> DataFrame:
    """Empty inputs against inputs that had text but gave nothing."""
    return df.agg(
        F.count_if(raw.isNull()).alias("empty"),
        F.count_if(raw.isNotNull() & parsed.isNull()).alias("unparseable"),
    )


def label_counts(df: DataFrame, label: Column, name: str = "label") -> DataFrame:
    """Rows per label."""
    return df.groupBy(label.alias(name)).agg(F.count("*").alias("n"))


def unresolved_counts(df: DataFrame, fks: list[str]) -> DataFrame:
    """NULLs per foreign key, and rows with at least one."""
    any_gap = F.greatest(*[F.col(k).isNull() for k in fks])
    return df.agg(
        *[F.count_if(F.col(k).isNull()).alias(k) for k in fks],
        F.count_if(any_gap).alias("rows_with_gaps"),
    )


def yearly_avg(df: DataFrame, value: str, since: int, digits: int = 2, name: str = "avg") -> DataFrame:
    """Average per year from a first year on, NULL values left out."""
    return (
        df.filter((F.col("year") >= since) & F.col(value).isNotNull())
        .groupBy("year")
        .agg(F.round(F.avg(value), digits).alias(name))
        .orderBy("year")
    )


__all__ = [
    "resolve_year", "histogram", "quartiles", "top_groups", "group_summary", "count_where",
    "value_counts", "miss_counts", "label_counts", "unresolved_counts", "yearly_avg",
    "quantiles", "ranked_value_counts",
]
