"""Do the quarantined rows account for the defects the source says it sent?"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.fixed_values import REASON_SEPARATOR


def reason_hits(quarantine: DataFrame) -> DataFrame:
    """Rows per load day and single rejection code; a row with two codes counts under both.

    Rows are counted under their composite reason first, so only the few composites are
    split.
    """
    # The separator is quoted because split() takes a regular expression.
    codes = F.split("dq_reason", r"\Q" + REASON_SEPARATOR + r"\E")
    return (
        quarantine.groupBy("load_date", "dq_reason")
        .agg(F.count("*").alias("_rows"))
        .select("load_date", F.explode(codes).alias("reason"), "_rows")
        .groupBy("load_date", "reason")
        .agg(F.sum("_rows").alias("quarantined_rows"))
    )


def reconcile(
    expected: DataFrame, quarantine_by_entity: Mapping[str, DataFrame], codes: Mapping[str, str]
) -> DataFrame:
    """Expected defects against rule hits per load day, entity and code.

    expected has load_date, issue_type ("entity.defect") and expected_rows. Several
    defects may answer to one code, and a code may also fire for rows the source did
    not spoil, so both sides are kept.
    """
    issue = F.col("issue_type")
    code = F.lit(None).cast("string")
    for defect, answer in codes.items():
        code = F.when(issue == defect, answer).otherwise(code)
    announced = (
        expected.select(
            "load_date",
            F.split_part(issue, F.lit("."), F.lit(1)).alias("entity"),
            F.coalesce(code, issue).alias("reason"),
            "expected_rows",
        )
        .groupBy("load_date", "entity", "reason")
        .agg(F.sum("expected_rows").alias("expected_rows"))
    )
    found = None
    for entity, quarantine in quarantine_by_entity.items():
        part = reason_hits(quarantine).withColumn("entity", F.lit(entity))
        found = part if found is None else found.unionByName(part)
    return (
        announced.join(found, ["load_date", "entity", "reason"], "full_outer")
        .na.fill(0, ["expected_rows", "quarantined_rows"])
        .withColumn("difference", F.col("quarantined_rows") - F.col("expected_rows"))
    )
