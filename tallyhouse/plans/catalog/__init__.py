"""Registered queries over the given tables, each with the SQL that says the same where there is one."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.plans.catalog.base import Tables
from tallyhouse.plans.catalog.sql import with_views
from tallyhouse.session import tune

_PARTS = ("columns", "tables", "models")


def entries() -> dict[str, tuple[Callable[[Tables], DataFrame], str | None]]:
    """Name to (query, SQL or None)."""
    found: dict = {}
    for part in _PARTS:
        found |= import_module(f"tallyhouse.plans.catalog.{part}").ENTRIES
    return found


def _bind(query: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(Tables(tune(spark), sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(query) for name, (query, _) in entries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, (_, sql) in entries().items() if sql is not None}
