"""Orders that outlived a deadline and what should have happened to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.functions.moments import days, hours
from dayledger.horizons import Deadlines


def overdue_orders(latest: DataFrame, as_of: str, terms: Deadlines | None = None) -> DataFrame:
    """Unpaid and uncollected orders past their deadline, with the reason and the moment due."""
    terms = terms or Deadlines()
    now = F.lit(as_of).cast("timestamp_ntz")
    unpaid_due = F.when(F.col("status") == "new", F.col("created_at") + hours(terms.payment_hours))
    uncollected_due = F.when(
        F.col("status") == "ready_for_pickup", F.col("ready_for_pickup_at") + days(terms.pickup_days)
    )
    due = F.coalesce(unpaid_due, uncollected_due)
    reason = F.when(F.col("status") == "new", "not_paid_in_time").otherwise("not_picked_up_in_time")
    return (
        latest.withColumn("due_at", due)
        .where(F.col("due_at").cast("timestamp_ntz") <= now)
        .select("order_id", "status", "due_at", reason.alias("overdue_reason"))
    )
