"""Registration of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, by default under its function's name, with the SQL that must give the
    same rows."""

    def register(query: Query) -> Query:
        key = name or query.__name__
        if key in QUERIES:
            raise ValueError(f"two queries named {key}")
        QUERIES[key] = query
        if sql is not None:
            ORACLES[key] = sql
        return query

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
