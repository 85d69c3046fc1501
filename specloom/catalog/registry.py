"""Where queries and their checks are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .inputs import Inputs

QUERIES: dict[str, Callable] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register `fn(inputs) -> DataFrame` under a name, with the SQL that must give the same rows."""

    def add(fn: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, root: fn(Inputs(spark, root, dealt=True))
        if check is not None:
            CHECKS[name] = check
        return fn

    return add


def sig(c: Column, digits: int = 9) -> Column:
    """Round to significant digits: sums of doubles differ between engines in the last bits."""
    return F.when(c.isNotNull(), F.format_string(f"%.{digits - 1}e", c).cast("double"))


def sig_sql(expr: str, digits: int = 9) -> str:
    return f"CAST(printf('%.{digits - 1}e', CAST({expr} AS DOUBLE)) AS DOUBLE)"
