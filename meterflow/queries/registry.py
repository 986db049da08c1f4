"""Registry of named queries: a Spark builder and, where SQL can say the
same thing, the DuckDB oracle text run against the same test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    ops: str


REGISTRY: dict[str, Query] = {}


def register(name: str, ops: str, oracle: str | None = None):
    def wrap(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, ops)
        return fn

    return wrap
