"""Query catalog: one Spark query and (where SQL can state it) one oracle SQL per operator.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver tables.
``oracle`` is 'S' (exact SQL), 'S*' (SQL on values rounded to 6
decimals) or 'R' (rows-only: learned or iterative values).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class QuerySpec:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    oracle: str
    doc: str


REGISTRY: dict[str, QuerySpec] = {}


def query(name: str, sql: str | Callable[[], str] | None = None, oracle: str = "S"):
    """Register a query; ``sql`` may be a string or a zero-argument builder."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        text = sql() if callable(sql) else sql
        REGISTRY[name] = QuerySpec(name, fn, text, oracle if text else "R", (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, QuerySpec]:
    from . import (catalog_clean, catalog_features, catalog_linear, catalog_models, catalog_profile,  # noqa: F401
                   catalog_scores, catalog_sources, catalog_splits, catalog_stream,
                   catalog_terms)
    return REGISTRY
