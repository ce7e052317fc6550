"""Registry of named queries: each is a Spark plan over the driver tables plus,
where the semantics are SQL-expressible, its DuckDB twin."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwheel.plans.oracle_views import with_views
from cartwheel.sources.tables import Tables

REGISTRY: dict[str, tuple[Callable[[Tables], DataFrame], str | None]] = {}

MODULES = [
    "cartwheel.plans.q_core",
    "cartwheel.plans.q_features",
    "cartwheel.plans.q_eval",
    "cartwheel.plans.q_prep",
    "cartwheel.plans.q_text_grid",
    "cartwheel.plans.q_models",
    "cartwheel.plans.q_stream",
]


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name`` with its oracle."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, with_views(sql, *views) if sql else None)
        return fn
    return deco


def _load():
    for m in MODULES:
        try:
            importlib.import_module(m)
        except ModuleNotFoundError as e:  # a module not written yet
            if e.name != m:
                raise


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {n: (lambda spark, sf_dir, _f=f: _f(Tables(spark, sf_dir))) for n, (f, _) in REGISTRY.items()}


def all_oracles() -> dict[str, str]:
    _load()
    return {n: s for n, (_, s) in REGISTRY.items() if s}
