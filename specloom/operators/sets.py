"""Set operations and result comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import comparable
from ..session import settle
from .ranking import first_per_key


def distinct(df: DataFrame, cols: list[str] | None = None, ordinal: str | None = None) -> DataFrame:
    """Distinct rows; for a subset of columns the lowest ordinal survives."""
    if cols is None:
        return df.distinct()
    if ordinal is None:
        raise ValueError("name an ordinal column: the surviving row must be defined")
    return first_per_key(df, cols, ordinal)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """X02."""
    return a.unionByName(b).distinct()


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows of a sorted frame 0, 1, 2, ... without one task seeing them all.

    The order is frozen by a checkpoint; each partition counts its rows, and a
    small table (one row per partition) holds the offsets.
    """
    place = F.monotonically_increasing_id()
    low = (1 << 33) - 1
    frozen = settle(df.withColumn("__part", F.spark_partition_id()).withColumn("__at", place.bitwiseAND(F.lit(low))))
    sizes = frozen.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    return frozen.join(offsets, "__part").withColumn(name, (F.col("__offset") + F.col("__at")).cast("long")).drop("__part", "__at", "__offset")


def _normalised(df: DataFrame, cols: list[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*[comparable(F.col(f"`{c}`"), kinds[c]).alias(c) for c in cols])


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that do not occur equally often on both sides, with the surplus of `a`."""
    cols = sorted(a.columns)
    both = _normalised(a, cols).withColumn("__w", F.lit(1)).unionAll(
        _normalised(b, cols).withColumn("__w", F.lit(-1))
    )
    return both.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.sum("__w").alias("surplus")).filter("surplus <> 0")


def results_equivalent(a: DataFrame, b: DataFrame, comparison: str = "set") -> bool:
    """Same column names and the same rows, as a multiset or position by position."""
    if set(a.columns) != set(b.columns):
        return False
    if comparison == "ordered":
        a, b = with_position(a, "__position"), with_position(b, "__position")
    return difference(a, b).isEmpty()
