"""The commit ledger: a day counts as loaded only while its marker is there."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.operators.lookups import join_by_key
from dayledger.session import side_by_side
from dayledger.sources.current import publish
from dayledger.sources.layers import clear_day, read_day, read_if_present, write_day
from dayledger.sources.schemas import LEDGER_SCHEMA

LEDGER = "_load_commits"
DATA_TABLES = (
    "customers",
    "orders",
    "payments",
    "quarantine_customers",
    "quarantine_orders",
    "quarantine_payments",
    "dq_metrics",
)


def read_ledger(spark: SparkSession, warehouse: str) -> DataFrame:
    """The rows of all markers. Markers of loads that were not given a commit have none."""
    path = f"{warehouse}/{LEDGER}"
    if read_if_present(spark, path) is None:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def commits_of(ledger: DataFrame) -> dict[date, str]:
    """The commit of every loaded day; one row a day comes to the driver."""
    return {r.load_date: r.commit for r in ledger.groupBy("load_date").agg(F.max("commit").alias("commit")).collect()}


def is_committed(spark: SparkSession, warehouse: str, load_date: str) -> bool:
    day = F.to_date(F.lit(load_date))
    return not read_ledger(spark, warehouse).where(F.col("load_date") == day).isEmpty()


def clear_load(spark: SparkSession, warehouse: str, load_date: str) -> None:
    """Forget a day. The marker goes first, so a crash here never leaves a day marked but empty."""
    for table in (LEDGER, *DATA_TABLES):
        clear_day(spark, warehouse, table, load_date)


def prepare_load(spark: SparkSession, warehouse: str, load_date: str, force: bool = False) -> bool:
    """False when the day is committed and not forced; otherwise the day is cleared for loading."""
    if is_committed(spark, warehouse, load_date) and not force:
        return False
    clear_load(spark, warehouse, load_date)
    return True


def record_commit(
    spark: SparkSession, warehouse: str, load_date: str, rows: Mapping[str, int], commit: str | None = None
) -> None:
    """Mark the day as complete: one row per table, written last. commit names the load."""
    marker = spark.createDataFrame(list(rows.items()), "entity string, rows bigint").withColumns(
        {"loaded_at": F.current_timestamp(), "commit": F.lit(commit or uuid.uuid4().hex)}
    )
    write_day(marker.coalesce(1), warehouse, LEDGER, load_date)


def committed_only(df: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of days that have a marker; a day of very many rows can be split in the join."""
    return join_by_key(df, ledger.select("load_date").distinct(), "load_date", "left_semi")


def ledger_listing(ledger: DataFrame) -> DataFrame:
    return ledger.select("load_date", "entity", "rows", "loaded_at").orderBy("load_date", "entity")


def load_day(
    spark: SparkSession,
    data_root: str,
    warehouse: str,
    load_date: str,
    force: bool = False,
    keep_current: bool = False,
) -> bool:
    """Append one processed day to the warehouse tables, at most once.

    Clean and quarantine rows and the metrics are written to the day's partitions; the
    marker is written only after all of them. keep_current also writes the state of the
    tables of latest versions that holds the day; the marker makes it visible.
    """
    if not prepare_load(spark, warehouse, load_date, force):
        return False
    places = {
        **{entity: (f"{data_root}/clean", entity) for entity in DATA_TABLES[:3]},
        **{f"quarantine_{entity}": (f"{data_root}/quarantine", entity) for entity in DATA_TABLES[:3]},
        "dq_metrics": (data_root, "dq_metrics"),
    }

    def copied(table: str) -> int:
        root, entity = places[table]
        write_day(read_day(spark, root, entity, load_date), warehouse, table, load_date)
        # Counted from the footers of the written files, not by computing the rows again.
        return read_day(spark, warehouse, table, load_date).count()

    counts = side_by_side(spark, [partial(copied, table) for table in places])
    rows = dict(zip(places, counts, strict=True))
    commit = uuid.uuid4().hex
    if keep_current:
        publish(spark, warehouse, load_date, commit, commits_of(read_ledger(spark, warehouse)))
    record_commit(spark, warehouse, load_date, rows, commit)
    return True
