"""Marts over the tables that load_day fills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dayledger.horizons import Horizons
from dayledger.plans.marts import Marts
from dayledger.sources.current import current_tables
from dayledger.sources.layers import read_layer
from dayledger.sources.ledger import DATA_TABLES, commits_of, committed_only, read_ledger


def warehouse_tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """Every loaded table, restricted to days whose load was completed."""
    ledger = read_ledger(spark, warehouse)
    tables = {"load_commits": ledger}
    for name in DATA_TABLES:
        table = read_layer(spark, warehouse, name)
        if table is None:
            raise FileNotFoundError(f"nothing loaded yet: {warehouse}/{name}")
        tables[name] = committed_only(table, ledger)
    return tables


def warehouse_marts(
    spark: SparkSession, warehouse: str, horizons: Horizons | None = None, current: bool = False
) -> Marts:
    """current reads the maintained tables of latest versions, where a state of them holds what
    the ledger says is loaded; otherwise, and by default, versions are resolved from the
    history.
    """
    tables = warehouse_tables(spark, warehouse)
    latest = current_tables(spark, warehouse, commits_of(tables["load_commits"])) if current else None
    if latest is None:
        return Marts(tables, horizons)
    return Marts(tables | latest, horizons, current=True)
