"""Registry of the queries run over the driver tables.

Each query is a function ``(spark, sf_dir) -> DataFrame``; where the result can
be written in SQL, the equivalent DuckDB SQL is registered with it (the
correctness oracle). Every computed column is aliased identically on both sides
and doubles are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco
