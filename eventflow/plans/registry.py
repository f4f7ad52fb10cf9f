"""Registered queries: name -> (callable, equivalent SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Epoch millis of the event time, rounded down as Spark does.
MS = "(epoch_us(ts) // 1000)"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load_all() -> None:
    """Import every query module."""
    from eventflow.plans import (  # noqa: F401
        q_bucketing,
        q_formats,
        q_interceptors,
        q_metrics,
        q_parsers,
        q_routing,
        q_sinks,
        q_storage,
    )
