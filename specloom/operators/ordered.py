"""Exact order statistics without a one-task sort.

Values are first counted (map-side), then cut into many ranges at sketched
splitters. The sketch only balances the work; the counts make the ranks exact.
No task ever holds more than one range of one key's distinct values, however hot
the key. There are at least as many ranges as shuffle partitions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store


#: Splitters compared in one step; a value's range is found in two steps, coarse and fine.
STEP = 64


def _ranges(df: DataFrame) -> int:
    """As many ranges as partitions, rounded up to whole steps."""
    return STEP * math.ceil(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) / STEP)


def _range_of(value: str, cuts: str) -> tuple[Column, Column]:
    """How many splitters lie below a value: among every 64th first, then among the 63 between."""
    below = lambda part: F.size(F.filter(part, lambda s: s < F.col(value)))
    coarse = F.when(F.size(cuts) < STEP, F.lit(0)).otherwise(
        below(F.transform(F.sequence(F.lit(STEP), F.size(cuts), F.lit(STEP)), lambda i: F.element_at(cuts, i))))
    return F.col("__coarse") * STEP + below(F.slice(cuts, F.col("__coarse") * STEP + 1, STEP - 1)), coarse


def ranked_value_counts(df: DataFrame, keys: list[str], value: str, ranges: int | None = None,
                        extra: dict | None = None, weight: str | None = None) -> DataFrame:
    """Distinct values per key: `n` rows each, `before` rows ranked below, `total` rows of the key.

    `extra` maps names to further aggregates to carry per distinct value; `weight`
    names a column that says how many rows a row stands for. The input is read
    once: the counts are stored, and splitters, range totals and ranks read them.
    """
    ranges = ranges or _ranges(df)
    amount = F.count("*") if weight is None else F.sum(weight)
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(amount.alias("n"), *[c.alias(k) for k, c in (extra or {}).items()])
    )
    counted = store(counted, "value-counts")
    cuts = [i / ranges for i in range(1, ranges)]
    splitters = counted.agg(F.percentile_approx(value, cuts, 10 * ranges).alias("s")).scalar()
    fine, coarse = _range_of(value, "__cuts")
    placed = counted.withColumn("__cuts", splitters).withColumn("__coarse", coarse).withColumn("__range", fine).drop("__cuts", "__coarse")
    # one row per key and range: at most `ranges` rows per key, whatever the data size
    totals = placed.groupBy(*keys, "__range").agg(F.sum("n").alias("__rows"))
    whole = Window.partitionBy(*keys)
    below = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "__range", F.coalesce(F.sum("__rows").over(below), F.lit(0)).alias("__offset"),
        F.sum("__rows").over(whole).alias("total"),
    )
    inside = Window.partitionBy(*keys, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("__inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*keys, "__range"]]
    out = [F.col(f"r.{c}").alias(c) for c in (*keys, value, "n", *(extra or {}))]
    joined = ranked.alias("r").join(offsets.alias("o"), on, "inner")
    return joined.select(*out, (F.col("o.__offset") + F.col("r.__inside")).alias("before"), "o.total")


def quantiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float], ranges: int | None = None,
              weight: str | None = None, least: int = 1) -> DataFrame:
    """Exact interpolated quantiles per key, one column per entry of `probs`.

    Keys with fewer than `least` values are left out.
    """
    ranked = ranked_value_counts(df, keys, value, ranges, weight=weight).filter(F.col("total") >= least)
    picks = []
    for name, p in probs.items():
        place = F.lit(p) * (F.col("total") - 1)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            hit = (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
            picks.append(F.max(F.when(hit, F.col(value).cast("double"))).alias(f"__{name}_{side}"))
    picked = ranked.groupBy(*keys).agg(F.max("total").alias("__total"), *picks)

    def blend(name, p):
        place = F.lit(p) * (F.col("__total") - 1)
        low, high = F.col(f"__{name}_lo"), F.col(f"__{name}_hi")
        return (low + (high - low) * (place - F.floor(place))).alias(name)

    return picked.select(*keys, *[blend(n, p) for n, p in probs.items()])


def every_kth(df: DataFrame, value: str, step: int, ranges: int | None = None) -> DataFrame:
    """Values at sorted positions 0, step, 2*step, ... as (position, value)."""
    first = F.ceil(F.col("before") / step) * step
    last = F.col("before") + F.col("n") - 1
    return (
        ranked_value_counts(df, [], value, ranges)
        .withColumn("first", first.cast("long"))
        .filter(F.col("first") <= last)
        .select(F.explode(F.sequence("first", last, F.lit(step).cast("long"))).alias("position"), value)
    )
