"""Rows re-issued under the same key on later days: which of them counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from dayledger.fixed_values import AWAITING_REFUND_STATUSES, MOVING_STATUSES


def _first_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # A rank filtered to 1 makes Spark keep one row per key in every map task before
    # the shuffle (WindowGroupLimit), so a key with very many versions stays cheap.
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    version: str = "load_date",
    tie_breaks: Sequence[str] = (),
) -> DataFrame:
    """One row per key, the newest version; tie_breaks (largest wins) settle equal versions."""
    order = [F.col(c).desc_nulls_last() for c in (version, *tie_breaks)]
    return _first_of(df, keys, order)


def first_version(
    df: DataFrame,
    keys: Sequence[str],
    version: str = "load_date",
    tie_breaks: Sequence[str] = (),
) -> DataFrame:
    """One row per key, the oldest version."""
    order = [F.col(c).asc_nulls_last() for c in (version, *tie_breaks)]
    return _first_of(df, keys, order)


def within_lookback(df: DataFrame, as_of: str, lookback_days: int, version: str = "load_date") -> DataFrame:
    """Versions loaded in the closed range [as_of - lookback_days, as_of]; prunes partitions."""
    day = F.to_date(F.lit(as_of))
    return df.where(F.col(version).between(F.date_sub(day, lookback_days), day))


def open_orders(
    history: DataFrame, as_of: str, lookback_days: int, tie_breaks: Sequence[str] = ()
) -> DataFrame:
    """Orders that may still change state as of a day, in their latest version."""
    latest = latest_version(
        within_lookback(history, as_of, lookback_days), ["order_id"], tie_breaks=tie_breaks
    )
    moving = F.col("status").isin(*MOVING_STATUSES)
    awaiting_refund = F.col("status").isin(*AWAITING_REFUND_STATUSES) & F.col("paid_at").isNotNull()
    return latest.where(moving | awaiting_refund)


def known_customers(history: DataFrame, as_of: str) -> DataFrame:
    """Customers registered no later than a day after as_of; the first batch of an id wins."""
    limit = F.date_add(F.to_date(F.lit(as_of)), 1).cast("timestamp_ntz")
    registered = history.where(F.col("registration_date").cast("timestamp_ntz") <= limit)
    return first_version(registered, ["customer_id"], tie_breaks=["registration_date"])


def has_unresolved_versions(df: DataFrame, key: str) -> DataFrame:
    """One row: total rows, distinct keys and whether versions are still unresolved."""
    return df.agg(
        F.count("*").alias("rows_total"), F.count_distinct(key).alias("keys_total")
    ).withColumn("unresolved", F.col("rows_total") > F.col("keys_total"))
