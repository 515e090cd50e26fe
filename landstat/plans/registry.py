"""The table of registered queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landstat.plans.bindings import oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, fn: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    """Registers ``fn`` under ``name``, with ``sql`` that may name the bound views."""
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = fn
    if sql:
        ORACLE_SQL[name] = oracle(sql)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded, negative zeros made zeros."""
    return df.select([(F.round(c, digits) + 0.0).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def load() -> tuple[dict, dict]:
    """All queries and SQL of the library."""
    from landstat.plans import agreement, area, labels, places, series  # noqa: F401

    return QUERIES, ORACLE_SQL
