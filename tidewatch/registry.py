"""Where the catalog's modules register their queries and SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.adapter import REPORTS_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, over_reports: bool = True):
    """Register a query; its SQL may start from ``reports`` or, with ``WITH``, from further tables."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            text = sql.strip()
            if over_reports:
                text = f"WITH {REPORTS_SQL}" + (f", {text[5:]}" if text[:5].upper() == "WITH " else f"\n{text}")
            ORACLE_SQL[name] = text
        return f

    return add
