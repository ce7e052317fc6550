"""Names of the operators' queries and, where SQL can express them, their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
MODULES = ["language", "secrets", "packing", "near_join", "url_filter", "warc", "decontaminate",
           "tool_calls", "exact_dedup", "html_text", "quality_rules", "token_align", "periodic_runs"]


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    for m in MODULES:
        importlib.import_module(f"cartwheel.llm.{m}")
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    all_queries()
    return dict(SQL)
