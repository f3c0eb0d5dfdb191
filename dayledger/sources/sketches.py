"""Sketches of a day's values, stored a partition per day and read for any period."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.operators.sketches import day_sketches, of_days
from dayledger.sources.layers import read_layer, write_day

DAY = "load_date"


def store_day(rows: DataFrame, root: str, name: str, day: str, group: str, value: str) -> None:
    """Replace one day's sketches by those of its rows; a day without rows leaves none."""
    dated = rows.withColumn(DAY, F.to_date(F.lit(day)))
    write_day(day_sketches(dated, DAY, group, value), root, name, day)


def store_days(rows: DataFrame, root: str, name: str, day: str, group: str, value: str) -> None:
    """Write the sketches of all days at once, where none are stored yet."""
    sketches = day_sketches(rows, day, group, value).withColumnRenamed(day, DAY)
    sketches.write.mode("errorifexists").partitionBy(DAY).parquet(f"{root}/{name}")


def read_sketches(
    spark: SparkSession, root: str, name: str, period: tuple[str, str] | None = None
) -> DataFrame:
    """Stored sketches, of all days or of a closed range, which alone is then read."""
    stored = read_layer(spark, root, name)
    if stored is None:
        raise FileNotFoundError(f"no sketches: {root}/{name}")
    return stored if period is None else of_days(stored, DAY, *period)
