"""Registered queries: one Spark function per operator, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

GROUPS = ["reading", "contracts", "ingest", "transforms", "asof", "panels", "intervals", "estimation", "audits",
          "inventories", "texts", "releases", "upkeep", "storage"]


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is the DuckDB statement it must equal."""
    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


def load_all() -> None:
    for group in GROUPS:
        import_module(f"vintara.queries.{group}")
