"""Registry of named queries: ``key -> (callable(spark, sf_dir), oracle SQL)``.

Each plan module registers its keys with ``@register``; the oracle SQL is
DuckDB text over the same driver tables (bindings are ``WITH`` clauses), or
None for the few keys SQL cannot express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(key: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key!r}")
        REGISTRY[key] = (fn, sql)
        return fn
    return deco


def _load_all() -> None:
    # Import for side effects: each module registers its keys.
    from tapeworks.plans import (  # noqa: F401
        q_contracts,
        q_discovery,
        q_documents,
        q_jobs,
        q_calendar,
        q_manifest,
        q_streams,
        q_timeline,
    )


def _in_utc(fn: QueryFn) -> QueryFn:
    """Contract instants are UTC: pin the session time zone before planning."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: _in_utc(fn) for k, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: sql for k, (_, sql) in REGISTRY.items() if sql is not None}
