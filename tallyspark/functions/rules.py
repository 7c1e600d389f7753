"""Ordered rules: a table of patterns compiled into one expression, the first that matches wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(text: Column, rules: list[tuple[str, str]], otherwise: str | None = None) -> Column:
    """The label of the first (pattern, label) that the text matches, letters in either case."""
    out = None
    for pattern, label in rules:
        hit = text.rlike(f"(?i){pattern}")
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(F.lit(otherwise))


def first_failure(checks: list[tuple[Column, str]]) -> Column:
    """The name of the first check that doesn't hold; null if all do. An unknown check fails."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for ok, name in checks])


def problems(checks: list[tuple[Column, str]]) -> Column:
    """The names of all checks that don't hold, comma-joined."""
    return F.array_join(F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for ok, name in checks])), ",")


def keyword_count(text: Column, pattern: str, least: int) -> Column:
    """Whether a pattern stands in the text ``least`` times or more."""
    return F.regexp_count(F.lower(text), F.lit(pattern)) >= least
