"""Registered queries over the given tables, each with its SQL counterpart.

A query without SQL is either not expressible there or too slow in SQL on the
whole tables; the tests check those against brute force on small fixtures.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a function of Tables under a name, with equivalent SQL."""

    def keep(build):
        from attesta.plans.driver_tables import Tables

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return keep


for _area in ("records", "tables", "texts", "models", "series", "files"):
    import_module(f"attesta.plans.catalog.{_area}")
