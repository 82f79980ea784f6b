"""Where the query modules enter their queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from firmloom.plans.fixtures_sql import with_ctes

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: Sequence[str] = ()) -> Callable[[QueryFn], QueryFn]:
    """Register a query; ``sql`` is its counterpart over the shared tables and ``ctes``."""

    def enter(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = with_ctes(ctes, sql)
        return fn

    return enter
