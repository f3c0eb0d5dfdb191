"""Order-based operators that keep a very large group out of any single task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def sequence_number(
    df: DataFrame, key: str, slot: Column, order_by: Sequence[str], out: str
) -> DataFrame:
    """row_number() per key, computed slot by slot.

    slot must not decrease along order_by (an hour for rows ordered by time). A row's
    number is its place inside (key, slot) plus the rows of the key in earlier slots, so
    the sort is spread over slots and only slot counts are accumulated per key.
    """
    # A struct is never NULL and compares NULL fields as equal, so rows with a NULL key
    # keep their group and the window and the join share one partitioning.
    slotted = df.withColumn("_slot", slot).withColumn("_group", F.struct(key, "_slot"))
    earlier = W.partitionBy(F.col("_group")[key]).orderBy(F.col("_group")["_slot"])
    offsets = (
        slotted.groupBy("_group")
        .agg(F.count("*").alias("_rows"))
        .select(
            "_group",
            F.coalesce(
                F.sum("_rows").over(earlier.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
            ).alias("_earlier"),
        )
    )
    place = F.row_number().over(W.partitionBy("_group").orderBy(*order_by))
    return (
        slotted.withColumn("_place", place)
        .join(offsets, "_group", "left")
        .withColumn(out, (F.col("_place") + F.col("_earlier")).cast("int"))
        .drop("_group", "_slot", "_place", "_earlier")
    )


def exact_percentiles(
    df: DataFrame, group: str, value: str, percentages: Mapping[str, float], slot_width: int
) -> DataFrame:
    """Exact interpolated percentiles of an integer column, one row per group.

    Rows are first counted per (group, value). Slot totals then locate the few slots
    that hold a wanted rank, and only the values of those slots are ranked. No task
    holds a group's values as a whole.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(group, value)
        .agg(F.count("*").alias("_n"))
        # Whole numbers all the way: a double would be inexact beyond 2^53.
        .withColumn("_slot", F.col(value) - F.pmod(F.col(value), F.lit(slot_width)))
    )
    along = W.partitionBy("_g").orderBy("_s").rowsBetween(W.unboundedPreceding, W.currentRow)
    slots = (
        counts.groupBy(F.col(group).alias("_g"), F.col("_slot").alias("_s"))
        .agg(F.sum("_n").alias("_in_slot"))
        .withColumn("_through", F.sum("_in_slot").over(along))
        .withColumn("_total", F.sum("_in_slot").over(W.partitionBy("_g")))
        .withColumn("_before", F.col("_through") - F.col("_in_slot"))
    )
    position = {name: F.lit(p) * (F.col("_total") - 1) for name, p in percentages.items()}

    def covers(lo: Column, hi: Column, rank: Column) -> Column:
        return (lo <= rank) & (rank < hi)

    wanted = F.lit(False)
    for p in position.values():
        for rank in (F.floor(p), F.ceil(p)):
            wanted = wanted | covers(F.col("_before"), F.col("_through"), rank)
    needed = slots.where(wanted).select("_g", "_s", "_before", "_total")

    inside = W.partitionBy("_g", "_s").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    # Null-safe, so no filter is pushed below the counting and both uses share its shuffle.
    same_slot = F.col(group).eqNullSafe(F.col("_g")) & F.col("_slot").eqNullSafe(F.col("_s"))
    ranked = (
        counts.join(needed, same_slot)
        .withColumn("_hi", F.col("_before") + F.sum("_n").over(inside))
        .withColumn("_lo", F.col("_hi") - F.col("_n"))
    )
    at_ranks = []
    for name, p in position.items():
        for side, rank in (("lower", F.floor(p)), ("upper", F.ceil(p))):
            hit = covers(F.col("_lo"), F.col("_hi"), rank)
            at_ranks.append(F.max(F.when(hit, F.col(value))).alias(f"_{name}_{side}"))
    picked = ranked.groupBy(group).agg(F.max("_total").alias("_total"), *at_ranks)
    return picked.select(
        group,
        *(
            (
                F.col(f"_{name}_lower") * (1 - (p - F.floor(p)))
                + F.col(f"_{name}_upper") * (p - F.floor(p))
            ).alias(name)
            for name, p in position.items()
        ),
    )
