"""Registered queries: one per operator, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from frameline.fixtures import Tables


@dataclass(frozen=True)
class Query:
    name: str
    rows: str  # survey rows covered
    run: Callable[[Tables], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, rows: str, sql: str | None = None):
    def register(run: Callable[[Tables], DataFrame]):
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Query(name, rows, run, sql)
        return run

    return register


def load() -> dict[str, Query]:
    """Import every registering module and return the catalog."""
    import importlib
    import pkgutil

    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    return CATALOG
