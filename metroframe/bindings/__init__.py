"""Driver tables bound to the operators: one registered query per operator,
each with an independent DuckDB SQL oracle where SQL can express it.

Every query reads the given tables (or files Spark writes from them) whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every binding module (each registers its queries)."""
    from metroframe.bindings import (  # noqa: F401
        catalog, curated, expressions, ingest, io, marts, spatial, streaming, text,
    )
