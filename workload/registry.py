"""Queries by name, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must agree."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = sql
        return fn

    return register


def rounded(column: str | Column) -> Column:
    """Six decimals without a negative zero, as the SQL side rounds."""
    return F.round(column, 6) + F.lit(0.0)


def with_rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: rounded(c) for c in columns})
