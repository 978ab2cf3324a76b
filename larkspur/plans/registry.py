"""Query registry and the SQL fragments the checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the same computation for DuckDB."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return add


def r6(column: Column | str) -> Column:
    """Six decimal places, without negative zero."""
    rounded = F.round(F.col(column) if isinstance(column, str) else column, 6)
    return F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)


def sql_r6(expression: str) -> str:
    return f"(case when round({expression}, 6) = 0 then 0.0::double else round({expression}, 6) end)"


def sql_bucket(key: str, buckets: int | str) -> str:
    return f"(('0x' || substr(md5(cast({key} as varchar)), 1, 8))::bigint % {buckets})"


def sql_list(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"
