"""Registry of named queries and their DuckDB oracle statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from urbanlens.plans.oracle_fixtures import with_fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
SECTIONS: dict[str, str] = {}


def query(key: str, sql: str | None = None, section: str = ""):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``.

    ``sql`` is the equivalent DuckDB statement over the driver tables; fixture
    views it mentions are expanded to CTEs. Leave it out for rows-only checks
    (randomised, ML or file-layout operators).
    """
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        SECTIONS[key] = section
        if sql is not None:
            ORACLES[key] = with_fixtures(sql)
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their queries register."""
    from urbanlens.plans import (  # noqa: F401
        q_aggregate, q_functions, q_grid, q_joins, q_scans, q_select, q_sinks,
        q_sort_set, q_stats, q_windows,
    )
