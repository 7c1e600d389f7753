"""All queries over the engine's own operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspark.plans import books, decisions, explorer, facts, holdings, landed, market, mergers, records, screens, terms

AREAS = (holdings, market, records, facts, screens, books, explorer, decisions, mergers, terms, landed)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for area in AREAS for name, query in area.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for area in AREAS for name, sql in area.SQL.items()}
