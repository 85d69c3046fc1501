"""Ranking, top-k, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import keep_groups


def first_ranked(df: DataFrame, keys: list, order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows per key. Spark cuts each partition to n before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def top_n(df: DataFrame, key: str, n: int, descending: bool = False, ties: list[Column] = ()) -> DataFrame:
    """Rows by one key, rows without it left out, at most n."""
    col = F.desc(key) if descending else F.asc(key)
    return df.filter(F.col(key).isNotNull()).orderBy(col, *ties).limit(n)


def best_per_key(df: DataFrame, keys: list[str], value: str, n: int, ties: list[Column] = ()) -> DataFrame:
    """The dearest row of each key, then the n dearest of those."""
    best = first_ranked(df.filter(F.col(value).isNotNull()), keys, [F.desc(value), *ties])
    return best.orderBy(F.desc(value), *ties).limit(n)


def best_per_top_groups(df: DataFrame, groups: DataFrame, key: str, value: str, ties: list[Column] = ()) -> DataFrame:
    """The dearest row of each listed group. `groups` is a LIMIT result."""
    inside = keep_groups(df, groups, key, bounded=True).filter(F.col(value).isNotNull())
    return first_ranked(inside, [key], [F.desc(value), *ties])


def top_per_period(df: DataFrame, period: str, group: str, name: str = "launches") -> DataFrame:
    """Per period the group with most rows, ties by name. The window sees counts, not rows."""
    counts = df.groupBy(period, group).agg(F.count("*").alias(name))
    return first_ranked(counts, [period], [F.desc(name), F.asc(group)])


def last_n_per_session(df: DataFrame, session: str, order: str, n: int = 5) -> DataFrame:
    """The newest n rows of each session, numbered oldest first."""
    if n < 1:
        raise ValueError("n must be at least 1")
    kept = first_ranked(df, [session], [F.desc(order)], n)
    place = F.row_number().over(Window.partitionBy(session).orderBy(order))
    return kept.withColumn("place", place)


def session_messages(turns: DataFrame, session: str, question: str, sql: str, preview: str) -> DataFrame:
    """W04 rendered: a user and an assistant message per remembered turn."""
    # The message wording.
    asked = F.concat(F.lit("(earlier question) "), F.col(question))
    answered = F.concat(
        F.lit("(my earlier answer)\n```sql\n"), F.col(sql),
        F.lit("\n```\nThat query produced this preview:\n"), F.col(preview),
    )
    pair = F.array(
        F.struct(F.lit("user").alias("role"), asked.alias("content")),
        F.struct(F.lit("assistant").alias("role"), answered.alias("content")),
    )
    return turns.select(session, "place", F.posexplode(pair).alias("part", "message")).select(
        session, "place", "part", "message.role", "message.content"
    )


def first_per_key(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """The row with the smallest ordinal per key, chosen before and after the shuffle."""
    return first_ranked(df, [F.col(f"`{k}`") for k in keys], [F.col(f"`{ordinal}`")])


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct known values in order."""
    return df.filter(F.col(col).isNotNull()).select(col).distinct().orderBy(col)


def hash_sample(df: DataFrame, n: int, key: list[str], seed: int = 0, per: list[str] = ()) -> DataFrame:
    """At most n rows (per group), the same rows on every run.

    Rows are ordered by a seeded hash of their key columns. The limit is the
    feature here: it is the sample size.
    """
    draw = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    ties = [F.col(k) for k in key]
    if per:
        return first_ranked(df.withColumn("__draw", draw), list(per), [F.col("__draw"), *ties], n).drop("__draw")
    return df.withColumn("__draw", draw).orderBy("__draw", *ties).limit(n).drop("__draw")
