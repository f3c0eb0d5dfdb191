"""Metric definitions over the marts. Every function returns one lazy DataFrame.

Money is summed in kopecks (exact integers) and divided by 100 at the end. Ratios are
NULL where the denominator is zero.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from dayledger.fixed_values import (
    CANCELLATION_LABELS,
    CAPITAL_CITY,
    NEW_ORDER_LABEL,
    RANKED_ENTITY_LABELS,
    REJECTED_SHARE_THRESHOLD,
    REPEAT_ORDER_LABEL,
    WEEK_OFFSET_PREFIX,
)
from dayledger.functions.moments import day_of
from dayledger.functions.text import labelled
from dayledger.operators.lookups import join_by_key
from dayledger.operators.ranking import exact_percentiles
from dayledger.operators.series import trailing_mean
from dayledger.operators.sketches import merged_percentiles
from dayledger.operators.versions import has_unresolved_versions
from dayledger.plans.marts import Marts

PERCENTILES = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
SECONDS_PER_HOUR = 3600
TOP_CITIES = 10


@dataclass(frozen=True)
class Filters:
    """Dashboard-wide filters: a closed range of days and any number of cities and channels.

    The period applies to each relation's own time column. City and channel are
    properties of the customer; channels are given by label.
    """

    period: tuple[str, str] | None = None
    cities: Sequence[str] = ()
    channels: Sequence[str] = ()

    def in_period(self, df: DataFrame, moment: str) -> DataFrame:
        if self.period is None:
            return df
        first, last = (F.to_date(F.lit(day)) for day in self.period)
        # Compared as timestamps, so the bounds can reach the scan.
        start = first.cast("timestamp_ntz")
        end = F.date_add(last, 1).cast("timestamp_ntz")
        return df.where((F.col(moment) >= start) & (F.col(moment) < end))

    def without_period(self) -> Filters:
        """For relations without a time column: a period is refused, not ignored."""
        if self.period is not None:
            raise ValueError("the relation has no time column that a period could apply to")
        return self

    def by_dimension(self, df: DataFrame) -> DataFrame:
        """For relations that carry city and channel themselves."""
        if self.cities:
            df = df.where(F.col("city").isin(*self.cities))
        if self.channels:
            df = df.where(F.col("acquisition_channel_ru").isin(*self.channels))
        return df

    def of_customers(self, df: DataFrame, marts: Marts) -> DataFrame:
        """For relations that only carry customer_id."""
        if not (self.cities or self.channels):
            return df
        chosen = self.by_dimension(marts.customers).select("customer_id")
        return join_by_key(df, chosen, "customer_id", "left_semi")


EVERYTHING = Filters()


def _orders(marts: Marts, filters: Filters) -> DataFrame:
    # The customer dimensions are only joined where a metric groups by them; filters on
    # them become a semi join.
    return filters.of_customers(filters.in_period(marts.orders, "created_at"), marts)


def _settled(marts: Marts, filters: Filters) -> DataFrame:
    return _orders(marts, filters).where("is_payment_settled")


def _mature(marts: Marts, filters: Filters) -> DataFrame:
    return _orders(marts, filters).where("is_mature")


def paid() -> Column:
    return F.col("paid_at").isNotNull()


def kept() -> Column:
    """Neither cancelled, nor returned, nor refunded."""
    return (
        F.col("cancelled_at").isNull()
        & F.col("returned_at").isNull()
        & F.col("refunded_at").isNull()
    )


def cancelled() -> Column:
    return F.col("cancelled_at").isNotNull()


def returned() -> Column:
    return F.col("returned_at").isNotNull()


def kopecks_if(condition: Column) -> Column:
    return F.when(condition, F.col("amount_kopecks")).otherwise(0)


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def _roubles(kopecks: Column) -> Column:
    return kopecks / 100


# --- headline numbers ------------------------------------------------------


def gmv_total(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    """Paid turnover of settled orders in millions."""
    kopecks = F.coalesce(F.sum(kopecks_if(paid())), F.lit(0))
    return _settled(marts, filters).agg((_roubles(kopecks) / 1_000_000).alias("gmv_millions"))


def order_count(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    return _orders(marts, filters).agg(F.count("*").alias("orders"))


def average_order_value(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    value = _share(_roubles(F.sum(kopecks_if(paid()))), F.count_if(paid()))
    return _settled(marts, filters).agg(value.alias("aov"))


def cancellation_share(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    share = _share(F.count_if(cancelled()), F.count("*"))
    return _mature(marts, filters).agg(share.alias("cancelled_share"))


def data_lag(marts: Marts) -> DataFrame:
    """The most outdated table decides."""
    return marts.load_freshness.agg(F.max("hours_since_load").alias("lag_hours"))


def rejected_share(dq_metrics: DataFrame, filters: Filters = EVERYTHING) -> DataFrame:
    share = _share(F.sum("invalid_rows"), F.sum("total_rows"))
    return filters.in_period(dq_metrics, "load_date").agg(share.alias("rejected_share"))


# --- daily series ----------------------------------------------------------


def gmv_by_day(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    """Paid and net turnover per day and their mean over seven rows."""
    daily = (
        _settled(marts, filters)
        .groupBy(day_of("created_at").alias("day"))
        .agg(
            F.sum(kopecks_if(paid())).alias("paid"),
            F.sum(kopecks_if(paid() & kept())).alias("net"),
        )
    )
    # Averaged as integers, so the mean does not depend on the order of addition.
    smooth = trailing_mean(daily, "day", ["paid", "net"])
    return smooth.select(
        "day",
        _roubles(F.col("paid")).alias("gmv_paid"),
        _roubles(F.col("net")).alias("gmv_net"),
        _roubles(F.col("paid_mean7")).alias("gmv_paid_mean7"),
        _roubles(F.col("net_mean7")).alias("gmv_net_mean7"),
    )


def average_order_value_by_day(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    """Daily ratio and the mean of the daily ratios; days without paid orders are skipped by it."""
    daily = (
        _settled(marts, filters)
        .groupBy(day_of("created_at").alias("day"))
        .agg(_share(_roubles(F.sum(kopecks_if(paid()))), F.count_if(paid())).alias("aov"))
    )
    return trailing_mean(daily, "day", ["aov"])


def outcome_shares_by_day(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    """Cancelled and returned shares of the orders created each day, unsmoothed."""
    return (
        _mature(marts, filters)
        .groupBy(day_of("created_at").alias("day"))
        .agg(
            _share(F.count_if(cancelled()), F.count("*")).alias("cancelled_share"),
            _share(F.count_if(returned()), F.count("*")).alias("returned_share"),
        )
    )


def statuses_by_day(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    return (
        _mature(marts, filters)
        .groupBy(day_of("created_at").alias("day"), "status_ru")
        .agg(F.count("*").alias("orders"))
    )


def cancellation_reasons_by_day(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    return (
        _orders(marts, filters)
        .where(cancelled())
        .groupBy(day_of("created_at").alias("day"), "cancellation_reason_ru")
        .agg(F.count("*").alias("orders"))
    )


def payment_success_by_day(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    """Share of attempts that were authorised; a later refund does not change it."""
    return (
        filters.in_period(marts.payments, "payment_date")
        .groupBy(day_of("payment_date").alias("day"))
        .agg(_share(F.count_if("attempt_succeeded"), F.count("*")).alias("success_share"))
    )


def rejected_share_by_day(
    dq_metrics: DataFrame,
    threshold: float = REJECTED_SHARE_THRESHOLD,
    filters: Filters = EVERYTHING,
) -> DataFrame:
    return (
        filters.in_period(dq_metrics, "load_date")
        .groupBy("load_date", labelled("entity", RANKED_ENTITY_LABELS).alias("entity"))
        .agg(_share(F.sum("invalid_rows"), F.sum("total_rows")).alias("rejected_share"))
        .withColumn("above_threshold", F.col("rejected_share") > threshold)
    )


def orders_by_day(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    daily = (
        _orders(marts, filters)
        .groupBy(day_of("created_at").alias("day"))
        .agg(F.count("*").alias("orders"))
    )
    return trailing_mean(daily, "day", ["orders"])


def registrations_by_day(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    registered = filters.by_dimension(filters.in_period(marts.customers, "registration_date"))
    daily = registered.groupBy(day_of("registration_date").alias("day")).agg(
        F.count("*").alias("registrations")
    )
    return trailing_mean(daily, "day", ["registrations"])


def new_and_repeat_orders_by_day(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    """A customer's first order is new, every other one is a repeat.

    Exactly one order per customer is the first and it falls on the day of the
    customer's earliest order, so two small aggregates answer this without numbering
    the orders. Which orders are first is decided on the whole history.
    """
    first_days = (
        filters.of_customers(marts.orders, marts)
        .groupBy("customer_id")
        .agg(F.min("created_at").alias("created_at"))
    )
    new = (
        filters.in_period(first_days, "created_at")
        .groupBy(day_of("created_at").alias("day"))
        .agg(F.count("*").alias("new"))
    )
    per_day = (
        _orders(marts, filters)
        .groupBy(day_of("created_at").alias("day"))
        .agg(F.count("*").alias("total"))
    )
    kinds = F.array(
        F.struct(F.lit(NEW_ORDER_LABEL).alias("kind"), F.col("new").alias("orders")),
        F.struct(F.lit(REPEAT_ORDER_LABEL).alias("kind"), (F.col("total") - F.col("new")).alias("orders")),
    )
    return (
        per_day.join(new, "day", "left")
        .na.fill(0, ["new"])
        .select("day", F.inline(kinds))
        .where("orders > 0")
    )


def refunds_by_day(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    """Refunded money by the day it went back, not by the day of the order."""
    refunded = filters.of_customers(
        filters.in_period(marts.orders.where("refunded_at IS NOT NULL"), "refunded_at"), marts
    )
    return refunded.groupBy(day_of("refunded_at").alias("day")).agg(
        _roubles(F.sum("amount_kopecks")).alias("refunded_amount")
    )


# --- breakdowns ------------------------------------------------------------


def _turnover(marts: Marts, orders: DataFrame, dimension: str) -> DataFrame:
    """Paid kopecks and paid orders per value of a customer dimension."""
    return marts.orders_summed_by_customer_dims(
        orders,
        dims=(dimension,),
        sums={"paid_kopecks": kopecks_if(paid()), "paid_orders": F.when(paid(), 1).otherwise(0)},
    ).select(
        dimension,
        _roubles(F.col("paid_kopecks")).alias("gmv"),
        _share(_roubles(F.col("paid_kopecks")), F.col("paid_orders")).alias("aov"),
    )


def _top_cities(marts: Marts, filters: Filters) -> DataFrame:
    return (
        _turnover(marts, _mature(marts, filters), "city")
        .orderBy(F.desc("gmv"), "city")
        .limit(TOP_CITIES)
    )


def gmv_by_city_top10(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    return _top_cities(marts, filters).select("city", "gmv")


def average_order_value_by_city_top10(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    """The ten cities with the largest turnover and their average order value."""
    return _top_cities(marts, filters).select("city", "aov")


def gmv_by_channel(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    channel = "acquisition_channel_ru"
    turnover = _turnover(marts, _mature(marts, filters), channel)
    return turnover.select(channel, "gmv").orderBy(F.desc("gmv"), channel)


def average_order_value_by_channel(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    channel = "acquisition_channel_ru"
    turnover = _turnover(marts, _mature(marts, filters), channel)
    return turnover.select(channel, "aov").orderBy(F.desc("aov"), channel)


def rule_hits(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    return (
        filters.in_period(marts.dq_reason_breakdown, "load_date")
        .groupBy("reason")
        .agg(F.sum("quarantined_rows").alias("hits"))
        .orderBy(F.desc("hits"), "reason")
    )


def funnel(marts: Marts) -> DataFrame:
    stages = marts.order_funnel_stages.groupBy("stage")
    return stages.agg(F.sum("cnt").alias("orders")).orderBy(F.desc("orders"), "stage")


def registrations_by_city(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    registered = filters.by_dimension(filters.in_period(marts.customers, "registration_date"))
    return (
        registered.groupBy("city")
        .agg(F.count("*").alias("registrations"))
        .orderBy(F.desc("registrations"), "city")
    )


def registration_share_by_channel(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    registered = filters.by_dimension(filters.in_period(marts.customers, "registration_date"))
    counted = registered.groupBy("acquisition_channel_ru").agg(F.count("*").alias("registrations"))
    # The window runs over the handful of channels, not over customers.
    total = F.sum("registrations").over(W.partitionBy())
    return counted.withColumn("share", _share(F.col("registrations"), total))


def cancellations_by_reason(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    return (
        _mature(marts, filters)
        .where(cancelled())
        .groupBy("cancellation_reason_ru")
        .agg(F.count("*").alias("orders"))
        .orderBy(F.desc("orders"), "cancellation_reason_ru")
    )


def payments_by_method_and_status(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    return (
        filters.in_period(marts.payments, "payment_date")
        .groupBy("payment_method_ru", "status_ru")
        .agg(F.count("*").alias("payments"))
    )


# --- distributions ---------------------------------------------------------


def first_order_delays(marts: Marts) -> DataFrame:
    delays = marts.first_order_delay_distribution.groupBy("days_to_first_order")
    return delays.agg(F.sum("customers").alias("customers")).orderBy("days_to_first_order")


def payment_attempts(marts: Marts) -> DataFrame:
    attempts = marts.payment_retries_distribution.groupBy("attempts")
    return attempts.agg(F.sum("orders_count").alias("orders")).orderBy("attempts")


def orders_per_customer(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    counts = filters.without_period().of_customers(marts.customer_order_counts, marts)
    return (
        counts.groupBy("orders_count").agg(F.count("*").alias("customers")).orderBy("orders_count")
    )


def _hours_by(durations: DataFrame, group: str) -> DataFrame:
    spread = exact_percentiles(
        durations, group, "duration_seconds", PERCENTILES, slot_width=SECONDS_PER_HOUR
    )
    return spread.select(group, *((F.col(p) / SECONDS_PER_HOUR).alias(p) for p in PERCENTILES))


def refund_hours(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    return _hours_by(filters.in_period(marts.refund_processing_times, "refunded_at"), "refund_kind")


def refund_durations_by_day(marts: Marts) -> DataFrame:
    """What sketches of refund hours are made of: refund_day, refund_kind, duration_seconds."""
    times = marts.refund_processing_times
    return times.select(day_of("refunded_at").alias("refund_day"), "refund_kind", "duration_seconds")


def refund_hours_sketched(sketches: DataFrame) -> DataFrame:
    """refund_hours from stored sketches of the days wanted, within sketches.RANK_ERROR."""
    spread = merged_percentiles(sketches, "refund_kind", PERCENTILES)
    return spread.select(
        "refund_kind", "values_total", *((F.col(p) / SECONDS_PER_HOUR).alias(p) for p in PERCENTILES)
    )


def stage_hours(marts: Marts) -> DataFrame:
    return _hours_by(marts.order_stage_durations, "stage").orderBy("stage")


def hourly_load(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    """Average orders per hour: filtered sum over all days of that weekday, busy or not."""
    per_hour = _share(F.sum("orders"), F.max("days"))
    return (
        filters.without_period()
        .by_dimension(marts.orders_by_hour_dow)
        .groupBy("dow_label", "hour_of_day")
        .agg(per_hour.alias("orders_per_hour"))
    )


def retention(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    """Mature cells only; the offset label sorts as text.

    The period applies to the cohort's week. Labels are as wide as the largest offset, two
    digits at least; they are made from the grid, which has a row per cohort and week.
    """
    cells = (
        filters.in_period(marts.customer_cohort_retention.where("is_mature"), "cohort_week_date")
        .groupBy("cohort_week", "weeks_since_signup")
        .agg(F.avg("retention_rate").alias("retention"))
    )
    number = F.col("weeks_since_signup").cast("string")
    longest = cells.agg(F.max(F.length(number))).scalar()
    width = F.greatest(F.lit(2), longest)
    label = F.concat(F.lit(WEEK_OFFSET_PREFIX), F.lpad(number, width, F.lit("0")))
    return cells.select("cohort_week", label.alias("week"), "retention")


def conversion(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    registered = filters.in_period(marts.customer_first_order, "registration_date")
    mature = filters.by_dimension(registered.where("is_mature"))
    share = _share(F.count_if("has_order"), F.count("*"))
    return mature.agg(share.alias("conversion"))


# --- findings --------------------------------------------------------------


def conversion_finding(marts: Marts) -> DataFrame:
    converted = F.count_if("has_order")
    return marts.customer_first_order.where("is_mature").agg(
        F.round(_share(converted * 100, F.count("*")), 1).alias("conversion_pct"),
        F.count("*").alias("total"),
        converted.alias("converted"),
        (F.count("*") - converted).alias("rest"),
    )


def cancellation_reason_finding(
    marts: Marts, reason: str = CANCELLATION_LABELS["not_paid_in_time"]
) -> DataFrame:
    hit = F.count_if(F.col("cancellation_reason_ru") == reason)
    share = F.round(_share(hit * 100, F.count("*")), 1)
    return marts.orders.where(F.col("is_mature") & cancelled()).agg(share.alias("share_pct"))


def city_share_finding(marts: Marts, city: str = CAPITAL_CITY) -> DataFrame:
    by_city = _turnover(marts, marts.orders.where("is_payment_settled"), "city")
    there = F.sum(F.when(F.col("city") == city, F.col("gmv")).otherwise(0))
    return by_city.agg(F.round(_share(there * 100, F.sum("gmv")), 1).alias("share_pct"))


def data_period(marts: Marts) -> DataFrame:
    return marts.orders.agg(
        day_of(F.min("created_at")).alias("first_day"), day_of(F.max("created_at")).alias("last_day")
    )


# --- diagnostics -----------------------------------------------------------


def status_histogram(marts: Marts) -> DataFrame:
    return marts.orders.groupBy("status").agg(F.count("*").alias("orders"))


def version_symptom(raw_orders: DataFrame) -> DataFrame:
    """More rows than orders is how a forgotten version resolution shows."""
    return has_unresolved_versions(raw_orders, "order_id")


def legacy_success_share(marts: Marts) -> DataFrame:
    """The older definition that loses refunded attempts, next to the current one."""
    success = F.col("status") == "success"
    settled = F.col("status").isin("success", "failed")
    return marts.payments.agg(
        _share(F.count_if(success), F.count_if(settled)).alias("legacy_share"),
        _share(F.count_if("attempt_succeeded"), F.count("*")).alias("success_share"),
    )


def weekday_daily_average(marts: Marts, filters: Filters = EVERYTHING) -> DataFrame:
    """Orders per weekday as an average per day that had orders."""
    daily = _orders(marts, filters).groupBy(day_of("created_at").alias("_day")).agg(
        F.count("*").alias("_orders")
    )
    weekday = (F.weekday("_day") + 1).alias("weekday")
    return daily.groupBy(weekday).agg(
        _share(F.sum("_orders"), F.count("*")).alias("orders_per_day")
    )
