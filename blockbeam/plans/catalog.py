"""Registry of named queries: each key maps to a Spark builder ``(spark, sf_dir)
-> DataFrame`` and, where SQL can express it, a DuckDB oracle string."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Builder, str | None]] = {}

MODULES = ("q_chain", "q_prices", "q_receivers", "q_splits", "q_scalars", "q_windows",
           "q_sources", "q_ml")


def query(key: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY and REGISTRY[key][0] is not fn:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    """Import every query module (registration happens at import)."""
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}")
    return REGISTRY
