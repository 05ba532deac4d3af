"""Registry of keyed queries: ``@query("key", oracle=SQL)`` on a
``(spark, sf_dir) -> DataFrame`` function. ``ORACLE[key]`` holds the DuckDB SQL
twin; a key without one is checked on row count only (or by its own tests)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(key: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def wrap(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn

    return wrap
