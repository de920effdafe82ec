"""Registration of named queries and their DuckDB oracle SQL.

A *plan* here is a named, parameterised query over the displacement views:
``fn(spark, sf_dir) -> DataFrame``. Each plan may carry an oracle: the same
question written as plain SQL over the driver tables (the fixture views are
prepended as CTEs), which DuckDB runs independently.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowatlas.schemas import ACTIVE_FORCED_TYPES, CROSS_BORDER_TYPES, EXCLUDED_STATUSES
from flowatlas.sources import fixtures
from flowatlas.sources.catalog import catalog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle_body: str | None = None, views: tuple[str, ...] = ("stock",)):
    """Register ``fn`` under ``key``; ``oracle_body`` is SQL over the fixture
    ``views`` (a body starting with ',' adds its own CTEs)."""
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle_body is not None:
            ORACLES[key] = fixtures.oracle(oracle_body, *views)
        return fn
    return deco


def views(spark: SparkSession, sf_dir: str):
    return catalog(spark, sf_dir)


# ------------------------------------------------------------- SQL snippets
def sql_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


CB = sql_list(CROSS_BORDER_TYPES)
ACTIVE = sql_list(ACTIVE_FORCED_TYPES)
LATEST_YEAR = "(SELECT max(year) FROM stock)"


def clean_sql(role: str, alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return (f"{a}{role}_iso3 IS NOT NULL AND {a}{role}_iso3 <> 'UNMAPPED' "
            f"AND NOT coalesce({a}{role}_mapping_status IN {sql_list(EXCLUDED_STATUSES)}, false)")
