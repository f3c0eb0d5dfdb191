"""Registered queries and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dayledger.sources.driver_tables import DriverTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the driver tables; sql is what must give the same rows."""

    def register(build: Callable[[DriverTables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(DriverTables(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
