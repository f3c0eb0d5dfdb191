"""Seventeen checks that keep known mistakes from coming back unseen.

Each returns one row (check_name, ok, detail) and nothing is collected until asked.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from dayledger.fixed_values import CLOSED_STATUSES, REASON_SEPARATOR
from dayledger.operators.lookups import join_by_key
from dayledger.plans.marts import NOWHERE, Marts
from dayledger.plans.metrics import kept, kopecks_if, paid


def _text(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _result(name: str, measured: DataFrame, ok: Column, detail: Column) -> DataFrame:
    return measured.select(
        F.lit(name).alias("check_name"), F.coalesce(ok, F.lit(False)).alias("ok"), detail.alias("detail")
    )


def _none(name: str, df: DataFrame, bad: Column) -> DataFrame:
    """Passes when no row is bad; the detail is the number of bad rows."""
    n = F.col("n")
    return _result(name, df.agg(F.count_if(bad).alias("n")), n == 0, _text(n))


def _equal(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """Passes when two one-cell relations agree."""
    both = left.toDF("a").select("a", right.toDF("b").scalar().alias("b"))
    a, b = F.col("a"), F.col("b")
    return _result(name, both, a == b, _text(a, " vs ", b))


def one_row_per_order(m: Marts) -> DataFrame:
    counted = m.orders.agg(F.count("*").alias("a"), F.count_distinct("order_id").alias("b"))
    return _result(
        "one_row_per_order", counted, F.col("a") == F.col("b"), _text(F.col("a"), " vs ", F.col("b"))
    )


def conversion_below_one(m: Marts) -> DataFrame:
    counted = m.customer_first_order.where("is_mature").agg(
        F.count_if("has_order").alias("a"), F.count("*").alias("b")
    )
    return _result(
        "conversion_below_one", counted, F.col("a") < F.col("b"), _text(F.col("a"), " of ", F.col("b"))
    )


def flag_agrees_with_date(m: Marts) -> DataFrame:
    bad = F.col("has_order") != F.col("first_order_at").isNotNull()
    return _none("flag_agrees_with_date", m.customer_first_order, bad)


def window_within_history(m: Marts) -> DataFrame:
    counted = m.customer_first_order.where("is_mature").agg(
        F.count_if("converted_within_window").alias("a"), F.count_if("has_order").alias("b")
    )
    return _result(
        "window_within_history", counted, F.col("a") <= F.col("b"), _text(F.col("a"), " <= ", F.col("b"))
    )


def no_epoch_first_order(m: Marts) -> DataFrame:
    epoch = F.to_date(F.col("first_order_at")) == F.to_date(F.lit("1970-01-01"))
    return _none("no_epoch_first_order", m.customer_first_order, epoch)


def join_keeps_orders(m: Marts) -> DataFrame:
    # A selected dimension keeps the optimizer from dropping the join under test.
    joined = m.orders_with_customer_dim.select(F.count(F.coalesce("city", F.lit(NOWHERE))))
    return _equal("join_keeps_orders", joined, m.orders.select(F.count("*")))


def every_order_has_city(m: Marts) -> DataFrame:
    return _none("every_order_has_city", m.orders_with_customer_dim, F.col("city") == NOWHERE)


def net_below_paid(m: Marts) -> DataFrame:
    sums = m.orders.where("is_mature").agg(
        F.sum(kopecks_if(paid() & kept())).alias("a"), F.sum(kopecks_if(paid())).alias("b")
    )
    return _result("net_below_paid", sums, F.col("a") < F.col("b"), _text(F.col("b"), " -> ", F.col("a")))


def refund_keeps_success(m: Marts) -> DataFrame:
    counted = m.payments.agg(
        F.count_if("attempt_succeeded").alias("a"),
        F.count_if(F.col("status").isin("success", "refunded")).alias("b"),
    )
    return _result(
        "refund_keeps_success", counted, F.col("a") == F.col("b"), _text(F.col("a"), " vs ", F.col("b"))
    )


def attempts_cover_orders(m: Marts) -> DataFrame:
    covered = m.payment_retries_distribution.select(F.sum("orders_count"))
    return _equal("attempts_cover_orders", covered, m.payments.select(F.count_distinct("order_id")))


def at_least_one_attempt(m: Marts) -> DataFrame:
    least = m.payment_retries_distribution.agg(F.min("attempts").alias("n"))
    return _result("at_least_one_attempt", least, F.col("n") >= 1, _text(F.col("n")))


def funnel_never_grows(m: Marts) -> DataFrame:
    # Five rows, one per stage.
    previous = F.lag("cnt").over(W.orderBy("stage_order"))
    stages = m.order_funnel_stages.withColumn("grew", F.col("cnt") > previous)
    summary = stages.agg(
        F.count_if("grew").alias("n"),
        F.sort_array(F.collect_list(F.struct("stage_order", "cnt"))).alias("stages"),
    )
    trail = F.array_join(F.transform("stages", lambda s: s["cnt"].cast("string")), " >= ")
    return _result("funnel_never_grows", summary, F.col("n") == 0, trail)


def payment_not_before_order(m: Marts) -> DataFrame:
    created = m.orders.select("order_id", "created_at")
    dated = join_by_key(m.payments.select("order_id", "payment_date"), created, "order_id", "inner")
    return _none("payment_not_before_order", dated, F.col("payment_date") < F.col("created_at"))


def grid_keeps_orders(m: Marts) -> DataFrame:
    in_grid = m.orders_by_hour_dow.select(F.sum("orders"))
    return _equal("grid_keeps_orders", in_grid, m.orders.select(F.count("*")))


def retention_grid_whole(m: Marts) -> DataFrame:
    measured = m.customer_cohort_retention.agg(
        F.count_if(F.col("retention_rate") > 1).alias("n"),
        F.min("weeks_since_signup").alias("lo"),
        F.max("weeks_since_signup").alias("hi"),
    )
    ok = (F.col("n") == 0) & (F.col("lo") == 0)
    return _result(
        "retention_grid_whole", measured, ok, _text(F.col("lo"), "..", F.col("hi"), ", ", F.col("n"))
    )


def open_orders_explained(m: Marts) -> DataFrame:
    """A mature order that is still open must have a rejected row to blame for it."""
    still_open = m.orders.where(F.col("is_mature") & ~F.col("status").isin(*CLOSED_STATUSES))
    blamed = m.tables["quarantine_orders"].select("order_id").distinct()
    unexplained = still_open.select("order_id").join(blamed, "order_id", "left_anti")
    return _none("open_orders_explained", unexplained, F.lit(True))


def reasons_are_single(m: Marts) -> DataFrame:
    composite = F.instr(F.col("reason"), REASON_SEPARATOR) > 0
    return _none("reasons_are_single", m.dq_reason_breakdown, composite)


CHECKS: tuple[Callable[[Marts], DataFrame], ...] = (
    one_row_per_order,
    conversion_below_one,
    flag_agrees_with_date,
    window_within_history,
    no_epoch_first_order,
    join_keeps_orders,
    every_order_has_city,
    net_below_paid,
    refund_keeps_success,
    attempts_cover_orders,
    at_least_one_attempt,
    funnel_never_grows,
    payment_not_before_order,
    grid_keeps_orders,
    retention_grid_whole,
    open_orders_explained,
    reasons_are_single,
)


class BrokenInvariant(AssertionError):
    pass


def report(marts: Marts) -> DataFrame:
    return reduce(DataFrame.unionByName, (check(marts) for check in CHECKS))


# What a broken check means for whoever reads the numbers.
MEANING = {
    "one_row_per_order": "orders are counted more than once in every metric",
    "conversion_below_one": "customers without an order are missing from the conversion",
    "flag_agrees_with_date": "conversion and first-order delays disagree",
    "window_within_history": "more customers convert in time than convert at all",
    "no_epoch_first_order": "a missing first order is taken for 1970",
    "join_keeps_orders": "the join with customers multiplies or loses orders",
    "every_order_has_city": "breakdowns by city lose orders",
    "net_below_paid": "refunds are not taken off the turnover",
    "refund_keeps_success": "refunds lower the share of successful payments",
    "attempts_cover_orders": "orders with payments are missing from the attempts",
    "at_least_one_attempt": "orders without an attempt are counted as paid for",
    "funnel_never_grows": "a later stage of the funnel has more orders than an earlier one",
    "payment_not_before_order": "payments are assigned to the wrong order",
    "grid_keeps_orders": "the hour grid multiplies or loses orders",
    "retention_grid_whole": "retention exceeds one or lacks the first week",
    "open_orders_explained": "orders stay open for no known reason",
    "reasons_are_single": "rows with several reasons are counted under a mixed one",
}


def enforce(marts: Marts, checks: Sequence[Callable[[Marts], DataFrame]] = CHECKS) -> None:
    """Raise with every check that does not hold, what was found and what it means.

    A check that can't run counts as broken, and the others still run.
    """
    broken = []
    for check in checks:
        try:
            # One row each, by construction.
            row = check(marts).first()
        except Exception as error:
            broken.append(f"{check.__name__}: could not run, {str(error).splitlines()[0]}")
            continue
        if not row["ok"]:
            name = row["check_name"]
            broken.append(f"{name}: {row['detail']} ({MEANING.get(name, 'no meaning given')})")
    if broken:
        raise BrokenInvariant("; ".join(broken))
