"""Queries over the given tables, one group per module."""

from dayledger.catalog import (  # noqa: F401
    invariants,
    lifecycle,
    loading,
    marts,
    metrics,
    primitives,
    quality,
    scalars,
)
from dayledger.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
