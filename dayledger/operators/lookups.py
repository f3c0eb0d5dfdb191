"""Enrichment a rule needs from other rows: copies in the load, earlier keys, parents.

Groups are only ever counted or reduced before a shuffle, and rows meet the result
through join_by_key, so one key holding a large share of the rows, or rows without a
key, do not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.operators.key_filter import key_filter, may_be_in

def join_by_key(df: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join many rows to the right side's rows by one key; NULL keys match nothing.

    Adaptive execution splits a hot key only where both inputs of the join come straight
    from a shuffle. A right side that was just grouped by the key would skip its shuffle
    and lose that, so the keys are compared null-safe: the comparison has its own
    partitioning and the (smaller) right side is shuffled for it.
    """
    side = right.where(F.col(key).isNotNull()).withColumnRenamed(key, "_key")
    joined = df.join(side, F.col(key).eqNullSafe(F.col("_key")), how)
    return joined.drop("_key")


def with_copies_in_load(
    df: DataFrame, key: str, out: str = "copies_in_load", keys_of: DataFrame | None = None
) -> DataFrame:
    """How many rows of the load share the row's key; NULL keys are counted together.

    Only keys seen more than once come back to the rows: on clean data that side is
    empty or tiny and adaptive execution turns the join into a broadcast. keys_of holds the
    same rows as df where their keys are cheaper to read, as before a join.
    """
    repeated = (
        (df if keys_of is None else keys_of)
        .select(F.col(key).alias("_key"))
        .groupBy("_key")
        .agg(F.count("*").alias("_copies"))
        .where("_copies > 1")
    )
    return (
        df.join(repeated, F.col(key).eqNullSafe(F.col("_key")), "left")
        .withColumn(out, F.coalesce("_copies", F.lit(1)))
        .drop("_key", "_copies")
    )


def of_keys_in(parents: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """The parents that rows of df refer to, and a few others.

    A filter of df's keys is applied where the parents are scanned, so what is shuffled of
    a long history follows the day's load. The caller's join on the key is what decides.
    """
    return parents.where(may_be_in(key_filter(df, key), key))


def with_presence(
    df: DataFrame, parents: DataFrame, key: str, out: str, keys_of: DataFrame | None = None
) -> DataFrame:
    """A flag that is true where the key exists among the parents and NULL where it does not.

    keys_of holds the same keys as df where these are cheaper to read, as before a join.
    """
    keys = of_keys_in(parents.select(key), df if keys_of is None else keys_of, key).distinct()
    return join_by_key(df, keys.withColumn(out, F.lit(True)), key)


def with_parent_moment(
    df: DataFrame,
    parents: DataFrame,
    key: str,
    moment: str,
    found: str,
    out: str,
    keys_of: DataFrame | None = None,
) -> DataFrame:
    """The parent's timestamp next to each row, and whether there is a parent at all.

    keys_of is as for with_presence. A parent may have several versions; its moment never changes, so the minimum is it.
    """
    keys = (
        of_keys_in(parents.select(key, moment), df if keys_of is None else keys_of, key)
        .groupBy(key)
        .agg(F.min(moment).alias(out))
        .withColumn(found, F.lit(True))
    )
    return join_by_key(df, keys, key)


def earlier_keys(
    clean: DataFrame,
    key: str,
    load_date: str,
    lookback_days: int,
    strictly_before: bool = True,
) -> DataFrame:
    """Rows of other loads inside the lookback window; the load_date bounds prune partitions.

    strictly_before=False also counts later days, which matters when an old day is re-run.
    """
    day = F.to_date(F.lit(load_date))
    bounded = clean.where(F.col("load_date") >= F.date_sub(day, lookback_days))
    other_days = F.col("load_date") < day if strictly_before else F.col("load_date") != day
    return bounded.where(other_days).select(key)
