"""Every operator as a query over the benchmark tables, with its statement in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corridor_metrics.registry.sqlviews import DIGITS, canonical, oracle
from corridor_metrics.testviews import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, columns: str | None = None, sql: str | None = None, use: str = "", digits: int = DIGITS):
    """Register a function of the tables as a query; with ``sql``, also its statement."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: canonical(fn(Tables(spark, folder)), digits)
        if sql is not None:
            ORACLES[name] = oracle(columns, sql, use, digits)
        return fn

    return wrap


def load() -> None:
    """Import the modules that register queries."""
    import importlib
    import pkgutil

    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
