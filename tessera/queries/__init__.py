"""Queries over the bridge: `QUERIES` and `ORACLES` by name."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tessera.plans.bridge import Bridge, ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, *needs: str, sql: str | None = None):
    """Registers f(bridge) under a name; sql follows the WITH list of the bridge names it needs (it may go on with ', x AS (...)')."""

    def add(f: Callable[[Bridge], DataFrame]):
        if name in QUERIES:
            raise KeyError(name)
        QUERIES[name] = lambda spark, sf_dir: f(Bridge(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = (ctes(*needs) + " " if needs else "") + sql
        return f

    return add


for module in ("core", "medallion", "serving", "quality", "upkeep"):
    import_module(f"tessera.queries.{module}")
