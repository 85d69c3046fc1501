"""Guarded ad-hoc SQL and scoring of answers."""

from __future__ import annotations

import re
import threading
import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sets import results_equivalent

# Default row cap and time limit in seconds.
ROW_CAP = 5000
TIME_LIMIT = 30
# Functions and clauses that can run code or read paths from inside a SELECT.
_DENIED = re.compile(
    r"\b(transform\s*\(.*?\busing\b|reflect\s*\(|try_reflect\s*\(|java_method\s*\("
    r"|read_files\s*\(|input_file_name\s*\()|\b(parquet|orc|csv|json|text|avro|binaryFile)\s*\.\s*`",
    re.IGNORECASE | re.DOTALL,
)
_QUOTED_OR_COMMENT = re.compile(r"'(?:[^'\\]|\\.|'')*'|--[^\n]*|/\*.*?\*/", re.DOTALL)


class UnsafeSQLError(ValueError):
    """The text is not a single read-only query."""


def guarded(spark: SparkSession, sql: str) -> DataFrame:
    """Exactly one SELECT, WITH or UNION, analysed but not yet run.

    Spark's own parser decides: as a subquery it takes nothing but a query. Two
    different wrappings keep unbalanced brackets from closing one of them early.
    """
    text = sql.strip().rstrip(";").strip()
    if not text:
        raise UnsafeSQLError("Empty SQL.")
    if _DENIED.search(_QUOTED_OR_COMMENT.sub(" '' ", text)):
        raise UnsafeSQLError("Disallowed function or path table.")
    try:
        spark.sql(f"WITH guarded_query AS (\n{text}\n) SELECT * FROM guarded_query LIMIT 0")
        return spark.sql(f"SELECT * FROM (\n{text}\n)")
    except ParseException as err:
        raise UnsafeSQLError(f"Only one SELECT statement is allowed: {err}") from err


def with_cap(df: DataFrame, cap: int = ROW_CAP) -> tuple[DataFrame, bool]:
    """At most `cap` rows, and whether there were more, from one read. The cap is the feature."""
    got = df.limit(cap + 1).collect()
    return df.sparkSession.createDataFrame(got[:cap], df.schema), len(got) > cap


@contextmanager
def time_limit(spark: SparkSession, seconds: float = TIME_LIMIT):
    """Cancel the jobs started inside after so many seconds; 0 switches it off."""
    if seconds <= 0:
        yield
        return
    sc, group = spark.sparkContext, f"specloom-{uuid.uuid4().hex}"
    sc.setJobGroup(group, "time-limited query", interruptOnCancel=True)
    timer = threading.Timer(seconds, sc.cancelJobGroup, [group])
    timer.daemon = True
    timer.start()
    try:
        yield
    finally:
        timer.cancel()
        sc.setLocalProperty("spark.jobGroup.id", None)


def run_readonly(spark: SparkSession, sql: str, cap: int = ROW_CAP, seconds: float = TIME_LIMIT):
    """D01-D03 together: (rows, truncated)."""
    df = guarded(spark, sql)
    with time_limit(spark, seconds):
        got = df.limit(cap + 1).collect()
    return got[:cap], len(got) > cap


def _markdown(header: list[str], rows: list) -> str:
    """A Markdown table; unknown values are empty cells."""
    cells = [header, ["---"] * len(header), *([("" if v is None else str(v)) for v in row] for row in rows)]
    bars = [(" | ", "| ", " |")] * len(cells)
    bars[1] = ("|", "|", "|")
    return "\n".join(left + between.join(line) + right for line, (between, left, right) in zip(cells, bars, strict=True))


def preview(df: DataFrame, n: int = 10) -> str:
    """The first n rows as a Markdown table, and how many more there are.

    The rows are read once; only a result with more than n rows is counted as well.
    """
    # The wording around the table.
    if not df.columns:
        return "(no columns returned)"
    shown = df.limit(n + 1).collect()
    if not shown:
        return f"(0 rows returned for columns: {', '.join(df.columns)})"
    total = len(shown) if len(shown) <= n else df.count()
    parts = [_markdown(df.columns, shown[:n])]
    if total > n:
        parts.append(f"…{total - n} more row(s) not shown.")
    return "\n\n".join([*parts, f"(returned {total} row(s))"])


SCORE_SCHEMA = (
    "qid string, sql string, reference_ok boolean, guard_passed boolean, executed boolean, result_correct boolean"
)


def score_one(spark: SparkSession, qid: str, answer_sql: str | None, reference_sql: str, comparison: str = "set"):
    """One scored answer as a row of SCORE_SCHEMA."""
    try:
        expected = spark.sql(reference_sql)
    except (ParseException, AnalysisException):
        return qid, answer_sql, False, False, False, False
    if not answer_sql:
        return qid, None, True, False, False, False
    try:
        got = guarded(spark, answer_sql)
    except UnsafeSQLError:
        return qid, answer_sql, True, False, False, False
    except AnalysisException:
        return qid, answer_sql, True, True, False, False
    try:
        correct = results_equivalent(got, expected, comparison)
    except Exception:  # a query that fails while running is a scored outcome
        return qid, answer_sql, True, True, False, False
    return qid, answer_sql, True, True, True, correct


def categorised(scores: DataFrame) -> DataFrame:
    """The outcome category per question."""
    category = (
        F.when(~F.col("reference_ok"), "reference-error")
        .when(F.coalesce(F.col("sql"), F.lit("")) == "", "no-sql")
        .when(~F.col("guard_passed"), "guard-rejected")
        .when(~F.col("executed"), "execution-error")
        .when(~F.col("result_correct"), "wrong-result")
        .otherwise("correct")
    )
    return scores.withColumn("category", category)


def scorecard(scores: DataFrame) -> DataFrame:
    """Totals over all questions, and the share of each in percent (0 without questions)."""
    flags = ("guard_passed", "executed", "result_correct")
    total = scores.agg(F.count("*").alias("n"), *[F.count_if(F.col(c)).alias(c) for c in flags])
    return total.withColumns({f"{c}_pct": F.col(c) * 100.0 / F.greatest("n", F.lit(1)) for c in flags})
