"""Registered queries: every operator run over the given tables, with its SQL check."""

from . import analytics, cleaning, loading, pages, questions, relational, statistics  # noqa: F401
from .registry import CHECKS, QUERIES  # noqa: F401
