"""Session settings the plans rely on; all of them are runtime SQL settings."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

RUNTIME_SETTINGS = {
    # Day and hour arithmetic is defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: join strategy by measured size, coalesced shuffles.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split over several tasks, also where the split costs one
    # more shuffle because a later step wanted the join's partitioning.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The last stage of a kept result is planned at run time, too: hot keys are split, small
    # partitions are put together and not written as a file each.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    # Keep inferred Python/Parquet behaviour independent of the host.
    "spark.sql.parquet.compression.codec": "zstd",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above and leave cluster sizing to whoever started the session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], T]]) -> list[T]:
    """Results of independent jobs started at once, so that the end of one leaves no core idle.

    Spark gives their tasks the same cores as before. All jobs end before an error is raised.
    """
    with ThreadPoolExecutor(max(len(jobs), 1)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in running]


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("dayledger")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    return tune(builder.getOrCreate())
