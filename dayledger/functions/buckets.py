"""Decisions that stay the same for an id from day to day: a hash slice as a uniform number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayledger.fixed_values import BUCKETS

SLICE_DIGITS = 12  # 48 bits, so the number fits a BIGINT


def stable_bucket(name: str, slice_no: int = 0) -> Column:
    """Uniform in [0, 1) from one slice of the id's MD5; other slices are independent.

    The digest has room for the slices 0 and 1.
    """
    if slice_no not in (0, 1):
        raise ValueError(f"no such slice: {slice_no}")
    digits = F.substring(F.md5(F.col(name).cast("binary")), slice_no * SLICE_DIGITS + 1, SLICE_DIGITS)
    number = F.conv(digits, 16, 10).cast("bigint")
    return (number % BUCKETS) / F.lit(float(BUCKETS))
