"""Queries over the test tables and their SQL counterparts."""

from workload import (  # noqa: F401
    macro_queries,
    market_queries,
    quality_queries,
    source_queries,
    table_queries,
    versioned_queries,
)
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
