"""Registered queries and, where plain SQL can say the same, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from claimworks import session

Query = Callable[[SparkSession, str], DataFrame]

MODULES = ["marts", "rules", "records", "quality", "x12", "lake", "risk", "streams"]


def _collect(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        merged.update(getattr(import_module(f"claimworks.registry.{name}"), attribute))
    return merged


def _tuned(query: Query) -> Query:
    """The caller's session gets the settings the plans were made for."""
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(session.tune(spark), sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _tuned(query) for name, query in _collect("QUERIES").items()}


def oracle_sql() -> dict[str, str]:
    return _collect("SQL")
