"""All queries of the library proper."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clipweave.plans import assembly, balance, catalog, corpus, signals, speech

MODULES = (corpus, speech, catalog, assembly, balance, signals)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name."""
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """The SQL of the queries that SQL can express."""
    return {name: s for m in MODULES for name, s in m.SQL.items()}
