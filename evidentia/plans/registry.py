"""Registered queries: ``(spark, sf_dir) -> DataFrame`` plus the DuckDB oracle SQL.

Every query reads the driver tables (whole tables, every row) or data Spark
derives from them. Long strings are compared through ``md5`` + ``length`` so the
oracle compares exact content without shipping megabytes of text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evidentia.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, as its files are split."""
    return read_table(spark, sf_dir, name)


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the query modules (each registers itself)."""
    from evidentia.plans import queries  # noqa: F401
