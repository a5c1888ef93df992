"""Named queries over the driver tables, each with an optional DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``oracle`` is an equivalent SQL text over the pre-registered table
    views; omit it only for operators SQL cannot express (model fitting,
    random ids), which then get a row-count check.
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


MODULES = ("basic", "joins", "warehouse", "logs", "io", "graph", "stream", "colour", "ml", "models", "edges")


def load_all() -> None:
    """Importing the plan modules fills the registry."""
    import importlib
    import pkgutil

    present = {m.name for m in pkgutil.iter_modules(importlib.import_module(__package__).__path__)}
    for mod in MODULES:
        if mod in present:
            importlib.import_module(f"{__package__}.{mod}")
