"""Named queries used by the driver contract and the benchmark."""

from __future__ import annotations

from . import files, landed, locations, readings, streams  # noqa: F401  (register)
from .registry import REGISTRY, Query


def queries() -> dict:
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql() -> dict:
    return {name: q.oracle for name, q in REGISTRY.items() if q.oracle}


__all__ = ["REGISTRY", "Query", "queries", "oracle_sql"]
