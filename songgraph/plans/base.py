"""Query registration: a name, a Spark callable, and (optionally) its DuckDB twin.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Each query's docstring lists the SURVEY operator IDs it covers. Queries
without an ``ORACLE`` entry (hash sampling, model training, streaming) are
checked by their own tests against a brute-force answer instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def cte(**views: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in views.items()) + "\n"


