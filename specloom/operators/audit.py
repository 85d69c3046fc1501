"""The cleaning audit over all columns at once.

Per audited column: how many rows have raw text, how many of those came to nothing, and the
most frequent raw texts among these. One scan counts everything and feeds a mergeable summary
of frequent texts for each column, a second one counts the summaries' texts exactly. The
summary is bounded, so a column may hold texts that it lost; its error bound tells. A column
whose last listed text is not safely above the bound is counted in full, so the result is exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import is_sentinel
from ..session import store


@dataclass
class Audit:
    """`counts`: (col, row_count, raw_present, fall_through); `values`: (col, raw, n); `flags`: (col, value, n)."""

    counts: DataFrame
    values: DataFrame
    flags: DataFrame


def _name(c: str) -> Column:
    return F.col(f"`{c}`")


def _states(frame: DataFrame, columns: dict[str, list[str]]) -> dict[str, tuple[Column, Column, Column]]:
    """Whether raw text is there, whether it came to nothing, and the text, of each cleaned column."""
    kinds = dict(frame.dtypes)
    out = {}
    for cleaned, raw in columns.items():
        known = [_name(c).isNotNull() for c in raw]
        present = F.greatest(*known) if len(known) > 1 else known[0]
        text = F.concat_ws(" | ", *[F.coalesce(_name(c).cast("string"), F.lit("")) for c in raw])
        out[cleaned] = (present, present & is_sentinel(_name(cleaned), kinds[cleaned]), text)
    return out


def _lost(frame: DataFrame, states: dict[str, tuple[Column, Column, Column]]) -> DataFrame:
    """(col, raw) of every text that came to nothing."""
    each = [F.when(lost, F.struct(F.lit(c).alias("col"), text.alias("raw"))) for c, (_, lost, text) in states.items()]
    return frame.select(F.inline(F.array_compact(F.array(*each))))


def audit_all(frame: DataFrame, columns: dict[str, list[str]], flags: list[str] = (), top: int = 20, listed: int = 200, tracked: int = 10_000) -> Audit:
    """L11 for all columns: two scans of the frame, a third one only for columns whose texts are too evenly spread.

    `flags` are 0/1 columns whose values are counted. Equal counts are settled by the text.
    """
    states = _states(frame, columns)
    sums = [F.count("*").alias("row_count")]
    for i, (present, lost, text) in enumerate(states.values()):
        frequent = F.call_function("approx_top_k", F.when(lost, text), F.lit(listed + 1), F.lit(tracked))  # NULL takes one place
        sums += [F.count_if(present).alias(f"present{i}"), F.count_if(lost).alias(f"lost{i}"), frequent.alias(f"top{i}")]
    for i, c in enumerate(flags):
        sums += [F.count_if(_name(c) == v).alias(f"flag{i}_{v}") for v in (0, 1)]
    one = store(frame.agg(*sums), "audit")  # one row
    row = [F.struct(F.lit(c).alias("col"), F.col("row_count"), F.col(f"present{i}").alias("raw_present"), F.col(f"lost{i}").alias("fall_through"),
                    F.col(f"top{i}").alias("frequent")) for i, c in enumerate(states)]
    summary = one.select(F.inline(F.array(*row)))
    flag = [F.struct(F.lit(c).alias("col"), F.lit(v).alias("value"), F.col(f"flag{i}_{v}").alias("n")) for i, c in enumerate(flags) for v in (0, 1)]
    counted = one.select(F.inline(F.array(*flag))) if flag else one.selectExpr("'' AS col", "0 AS value", "0L AS n").limit(0)

    # at most `listed` texts a column, so this side has a bound of its own
    wanted = summary.select("col", F.inline("frequent")).where("item IS NOT NULL").select("col", F.col("item").alias("raw"))
    exact = store(_lost(frame, states).join(F.broadcast(wanted), ["col", "raw"]).groupBy("col", "raw").agg(F.count("*").alias("n")), "audit-values")
    place = F.row_number().over(Window.partitionBy("col").orderBy(F.desc("n"), F.asc("raw")))
    ranked = exact.withColumn("place", place)  # a bounded list a column
    # a text outside the summary: not above the last one kept, and the error of the summary on either side of it
    error = 3.5 / tracked
    entries = F.size("frequent")
    last = F.when(entries > listed, F.array_min(F.transform("frequent", lambda f: f["count"]))).otherwise(0)
    unseen = summary.select("col", "fall_through", (last + 3 * error * F.col("row_count")).alias("bound"))
    reached = exact.groupBy("col").agg(F.sum("n").alias("covered")).join(ranked.where(F.col("place") == top).select("col", F.col("n").alias("least")), "col", "left")
    open_ones = unseen.join(reached, "col", "left").where(
        (F.col("fall_through") > F.coalesce("covered", F.lit(0))) & ~F.coalesce(F.col("least") > F.col("bound"), F.lit(False)))
    even = {r["col"] for r in open_ones.select("col").collect()}  # column names
    best = ranked.where(F.col("place") <= top).select("col", "raw", "n")
    if even:
        full = _lost(frame, {c: s for c, s in states.items() if c in even}).groupBy("col", "raw").agg(F.count("*").alias("n"))
        full = full.withColumn("place", place).where(F.col("place") <= top).select("col", "raw", "n")
        best = best.where(~F.col("col").isin(*even)).unionByName(full)
    return Audit(summary.drop("frequent"), best, counted)
