"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` plus DuckDB oracle SQL.

Each sub-module registers the queries of one area with ``@register``.  The SQL
names the stand-in views it needs; they are prefixed as CTEs so DuckDB can run
it on the driver tables directly.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package
from ..standins import Tables, with_views


@dataclass
class Entry:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, views: tuple = ()):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name`` with its oracle SQL."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(Tables(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Entry(run, with_views(sql, *views) if sql else None)
        return fn
    return deco


def _load_all():
    from . import (dashboard, analyses, cleaning_q, joins_q, text_q, windows_q, recommend_q,  # noqa: F401
                   sinks_q, sources_q, streaming_q, model_q, reports_q)


def queries() -> dict:
    _load_all()
    return {k: e.fn for k, e in REGISTRY.items()}


def oracle_sql() -> dict:
    _load_all()
    return {k: e.sql for k, e in REGISTRY.items() if e.sql}
