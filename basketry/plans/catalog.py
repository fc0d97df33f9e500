"""Registry of named queries: every entry is a Spark plan over the test
tables (``queries()``) and, when SQL can express it, the matching DuckDB
statement (``oracle_sql()``).  Keys start with the operator id of the
inventory (``b7_dedup_rows``, ``d2_rfm`` ...)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from . import queries_core  # noqa: F401
    from . import queries_analytics  # noqa: F401
    from . import queries_models  # noqa: F401
