"""Registry of queries and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tiffin.catalog.oracle import assemble
from tiffin.sources.bronze import Bronze

Query = Callable[[Bronze], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the bronze views of the oracle by name."""
    def add(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = assemble(sql)
        return fn
    return add
