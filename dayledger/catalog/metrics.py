"""Q01 to Q42."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.catalog.marts import FRESHNESS, NUMBERED, STAGE_DURATIONS, sparse
from dayledger.catalog.oracle import business, case, clock, raw_all
from dayledger.catalog.registry import query
from dayledger.fixed_values import RANKED_ENTITY_LABELS
from dayledger.operators import sketches
from dayledger.plans import metrics as m
from dayledger.sources import layers
from dayledger.sources import sketches as stored

PAID = "paid_at IS NOT NULL"
KEPT = "cancelled_at IS NULL AND returned_at IS NULL AND refunded_at IS NULL"
GMV = f"sum(CASE WHEN {PAID} THEN amount_kopecks ELSE 0 END)::BIGINT / 100"
NET = f"sum(CASE WHEN {PAID} AND {KEPT} THEN amount_kopecks ELSE 0 END)::BIGINT / 100"
AOV = f"{GMV} / nullif(count(paid_at), 0)"
DAY = "CAST(created_at AS DATE)"
WEEK = "OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"

query(
    "q01_gmv_total", business(f"SELECT {GMV} / 1000000 AS gmv_millions FROM od WHERE is_payment_settled")
)(lambda t: m.gmv_total(t.marts))
query("q02_order_count", business("SELECT count(*) AS orders FROM od"))(lambda t: m.order_count(t.marts))
query("q03_average_order_value", business(f"SELECT {AOV} AS aov FROM od WHERE is_payment_settled"))(
    lambda t: m.average_order_value(t.marts)
)
query(
    "q04_cancellation_share",
    business("SELECT count(cancelled_at) / count(*) AS cancelled_share FROM od WHERE is_mature"),
)(lambda t: m.cancellation_share(t.marts))
query("q05_data_lag", business(f"SELECT max(hours_since_load) AS lag_hours FROM ({FRESHNESS})"))(
    lambda t: m.data_lag(t.marts)
)
query(
    "q06_rejected_share",
    raw_all("SELECT sum(invalid_rows)::DOUBLE / sum(total_rows)::DOUBLE AS rejected_share FROM dqm"),
)(lambda t: m.rejected_share(t.dq_metrics))


@query(
    "q07_gmv_by_day",
    business(
        f"""SELECT day, gmv_paid / 100 AS gmv_paid, gmv_net / 100 AS gmv_net,
        avg(gmv_paid) {WEEK} / 100 AS gmv_paid_mean7, avg(gmv_net) {WEEK} / 100 AS gmv_net_mean7
        FROM (SELECT {DAY} AS day, sum(CASE WHEN {PAID} THEN amount_kopecks ELSE 0 END)::BIGINT AS gmv_paid,
                sum(CASE WHEN {PAID} AND {KEPT} THEN amount_kopecks ELSE 0 END)::BIGINT AS gmv_net
              FROM od WHERE is_payment_settled GROUP BY 1)"""
    ),
)
def _(t):
    return m.gmv_by_day(t.marts)


@query(
    "q08_average_order_value_by_day",
    business(
        f"""SELECT day, round(aov, 6) AS aov, round(avg(aov) {WEEK}, 4) AS aov_mean7
        FROM (SELECT {DAY} AS day, {AOV} AS aov FROM od WHERE is_payment_settled GROUP BY 1)"""
    ),
)
def _(t):
    # A mean of fractions depends on the order of addition in its last digits.
    return m.average_order_value_by_day(t.marts).select(
        "day", F.round("aov", 6).alias("aov"), F.round("aov_mean7", 4).alias("aov_mean7")
    )


query(
    "q09_outcome_shares_by_day",
    business(
        f"""SELECT {DAY} AS day, count(cancelled_at) / count(*) AS cancelled_share,
        count(returned_at) / count(*) AS returned_share FROM od WHERE is_mature GROUP BY 1"""
    ),
)(lambda t: m.outcome_shares_by_day(t.marts))
query(
    "q10_statuses_by_day",
    business(f"SELECT {DAY} AS day, status_ru, count(*) AS orders FROM od WHERE is_mature GROUP BY 1, 2"),
)(lambda t: m.statuses_by_day(t.marts))
query(
    "q11_first_order_delays",
    sparse(
        """SELECT days_to_first_order, count(*) AS customers FROM sfo
        WHERE is_mature AND days_to_first_order >= 0 GROUP BY 1"""
    ),
)(lambda t: m.first_order_delays(t.sparse_marts))
query(
    "q12_conversion",
    sparse(
        "SELECT sum(CAST(has_order AS INTEGER))::DOUBLE / count(*) AS conversion FROM sfo WHERE is_mature"
    ),
)(lambda t: m.conversion(t.sparse_marts))

HOURS = "quantile_cont(duration_seconds, {p}) / 3600"
REFUND_DURATIONS = """SELECT CASE WHEN cancelled_at IS NOT NULL THEN 'Отмена' ELSE 'Возврат товара' END
    AS refund_kind, date_diff('second', coalesce(cancelled_at, returned_at), refunded_at) AS duration_seconds
  FROM mo WHERE refunded_at >= coalesce(cancelled_at, returned_at)"""
SPREAD = ", ".join(f"round({HOURS.format(p=p)}, 6) AS p{round(p * 100)}" for p in (0.5, 0.9, 0.99))


def _rounded(df, group):
    return df.select(group, *(F.round(p, 6).alias(p) for p in m.PERCENTILES))


query(
    "q13_refund_hours",
    business(f"SELECT refund_kind, {SPREAD} FROM ({REFUND_DURATIONS}) GROUP BY refund_kind"),
)(lambda t: _rounded(m.refund_hours(t.marts), "refund_kind"))



@query(
    "q13_refund_hours_sketched",
    business(
        f"SELECT refund_kind, count(*) AS values_total, true AS within FROM ({REFUND_DURATIONS}) GROUP BY 1"
    ),
)
def _(t) -> DataFrame:
    """Sketches stored by the day of the refund, merged for all days, against the exact ranks."""
    root, durations = layers.shared_folder(t.spark, "q13"), m.refund_durations_by_day(t.marts)
    stored.store_days(durations, root, "refunds", "refund_day", "refund_kind", "duration_seconds")
    found = stored.read_sketches(t.spark, root, "refunds")
    checked = sketches.checked_percentiles(durations, found, "refund_kind", "duration_seconds", m.PERCENTILES)
    return checked.select("refund_kind", "values_total", "within")


TOP = f"""SELECT city, {GMV} AS gmv, {AOV} AS aov FROM od WHERE is_mature
  GROUP BY city ORDER BY gmv DESC, city LIMIT 10"""
query("q14_average_order_value_by_city_top10", business(f"SELECT city, aov FROM ({TOP})"))(
    lambda t: m.average_order_value_by_city_top10(t.marts)
)
query("q15_gmv_by_city_top10", business(f"SELECT city, gmv FROM ({TOP})"))(
    lambda t: m.gmv_by_city_top10(t.marts)
)
query(
    "q16_rule_hits",
    raw_all("SELECT reason, sum(quarantined_rows)::BIGINT AS hits FROM reasons GROUP BY 1"),
)(lambda t: m.rule_hits(t.marts))
query(
    "q17_gmv_by_channel",
    business(f"SELECT acquisition_channel_ru, {GMV} AS gmv FROM od WHERE is_mature GROUP BY 1"),
)(lambda t: m.gmv_by_channel(t.marts))
query(
    "q18_average_order_value_by_channel",
    business(f"SELECT acquisition_channel_ru, {AOV} AS aov FROM od WHERE is_mature GROUP BY 1"),
)(lambda t: m.average_order_value_by_channel(t.marts))
query(
    "q19_funnel",
    business(
        """SELECT 'Создано' AS stage, count(*) AS orders FROM mo WHERE is_mature
        UNION ALL SELECT 'Оплачено', count(paid_at) FROM mo WHERE is_mature
        UNION ALL SELECT 'Отправлено', count(shipped_at) FROM mo WHERE is_mature
        UNION ALL SELECT 'Готово к выдаче', count(ready_for_pickup_at) FROM mo WHERE is_mature
        UNION ALL SELECT 'Доставлено', count(delivered_at) FROM mo WHERE is_mature"""
    ),
)(lambda t: m.funnel(t.marts))
query(
    "q20_registrations_by_city",
    business("SELECT city, count(*) AS registrations FROM mc GROUP BY city"),
)(lambda t: m.registrations_by_city(t.marts))
query(
    "q21_cancellations_by_reason",
    business(
        """SELECT cancellation_reason_ru, count(*) AS orders FROM od
        WHERE is_mature AND cancelled_at IS NOT NULL GROUP BY 1"""
    ),
)(lambda t: m.cancellations_by_reason(t.marts))
query(
    "q22_registration_share_by_channel",
    business(
        """SELECT acquisition_channel_ru, count(*) AS registrations,
        count(*)::DOUBLE / (SELECT count(*) FROM mc) AS share FROM mc GROUP BY 1"""
    ),
)(lambda t: m.registration_share_by_channel(t.marts))
query(
    "q23_cancellation_reasons_by_day",
    business(
        f"""SELECT {DAY} AS day, cancellation_reason_ru, count(*) AS orders FROM od
        WHERE cancelled_at IS NOT NULL GROUP BY 1, 2"""
    ),
)(lambda t: m.cancellation_reasons_by_day(t.marts))
query(
    "q24_payment_success_by_day",
    business(
        """SELECT CAST(payment_date AS DATE) AS day,
        count(*) FILTER (WHERE attempt_succeeded) / count(*) AS success_share FROM mp GROUP BY 1"""
    ),
)(lambda t: m.payment_success_by_day(t.marts))
query(
    "q25_rejected_share_by_day",
    raw_all(
        f"""SELECT *, rejected_share > 0.05 AS above_threshold FROM (
        SELECT load_date, {case("entity", RANKED_ENTITY_LABELS)} AS entity,
               sum(invalid_rows)::DOUBLE / sum(total_rows)::DOUBLE AS rejected_share FROM dqm GROUP BY 1, 2)"""
    ),
)(lambda t: m.rejected_share_by_day(t.dq_metrics))
query("q26_stage_hours", business(f"SELECT stage, {SPREAD} FROM ({STAGE_DURATIONS}) GROUP BY stage"))(
    lambda t: _rounded(m.stage_hours(t.marts), "stage")
)
query(
    "q27_hourly_load",
    clock(
        """SELECT dow_label, hour_of_day, sum(orders)::DOUBLE / max(days) AS orders_per_hour
        FROM hour_grid GROUP BY 1, 2"""
    ),
)(lambda t: m.hourly_load(t.clock_marts))
query(
    "q28_retention",
    clock(
        """SELECT cohort_week, 'нед. ' || lpad(CAST(weeks_since_signup AS VARCHAR), 2, '0') AS week,
        avg(retention_rate) AS retention FROM cohort_grid WHERE is_mature GROUP BY 1, 2"""
    ),
)(lambda t: m.retention(t.clock_marts))
query(
    "q29_orders_by_day",
    business(
        f"""SELECT day, orders, avg(orders) {WEEK} AS orders_mean7
        FROM (SELECT {DAY} AS day, count(*) AS orders FROM od GROUP BY 1)"""
    ),
)(lambda t: m.orders_by_day(t.marts))
query(
    "q30_registrations_by_day",
    business(
        f"""SELECT day, registrations, avg(registrations) {WEEK} AS registrations_mean7
        FROM (SELECT CAST(registration_date AS DATE) AS day, count(*) AS registrations FROM mc GROUP BY 1)"""
    ),
)(lambda t: m.registrations_by_day(t.marts))
query(
    "q31_new_and_repeat_orders_by_day",
    business(
        f"""SELECT {DAY} AS day, CASE WHEN order_seq = 1 THEN 'Новый' ELSE 'Повторный' END AS kind,
        count(*) AS orders FROM ({NUMBERED.format(orders="mo")}) GROUP BY 1, 2"""
    ),
)(lambda t: m.new_and_repeat_orders_by_day(t.marts))
query(
    "q32_refunds_by_day",
    business(
        """SELECT CAST(refunded_at AS DATE) AS day, sum(amount_kopecks)::BIGINT / 100 AS refunded_amount
        FROM od WHERE refunded_at IS NOT NULL GROUP BY 1"""
    ),
)(lambda t: m.refunds_by_day(t.marts))
query(
    "q33_payments_by_method_and_status",
    business("SELECT payment_method_ru, status_ru, count(*) AS payments FROM mp GROUP BY 1, 2"),
)(lambda t: m.payments_by_method_and_status(t.marts))
ATTEMPTS = "SELECT order_id, count(*) AS attempts FROM mp GROUP BY order_id"
query(
    "q34_payment_attempts", business(f"SELECT attempts, count(*) AS orders FROM ({ATTEMPTS}) GROUP BY 1")
)(lambda t: m.payment_attempts(t.marts))
query(
    "q35_orders_per_customer",
    business(
        """SELECT orders_count, count(*) AS customers
        FROM (SELECT customer_id, count(*) AS orders_count FROM mo GROUP BY 1) GROUP BY 1"""
    ),
)(lambda t: m.orders_per_customer(t.marts))

FILTERS = m.Filters(
    period=("1997-01-01", "1999-12-31"),
    cities=("NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_8"),
    channels=("Прямые заходы", "Прочие соцсети"),
)
FILTERED = """created_at >= '1997-01-01' AND created_at < '2000-01-01'
  AND city IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_8')
  AND acquisition_channel_ru IN ('Прямые заходы', 'Прочие соцсети')"""
query(
    "q36_filtered_gmv_by_city",
    business(
        f"""SELECT city, {GMV} AS gmv FROM od WHERE is_mature AND {FILTERED}
        GROUP BY city ORDER BY gmv DESC, city LIMIT 10"""
    ),
)(lambda t: m.gmv_by_city_top10(t.marts, FILTERS))
query(
    "q36_filtered_statuses_by_day",
    business(
        f"""SELECT {DAY} AS day, status_ru, count(*) AS orders FROM od
        WHERE is_mature AND {FILTERED} GROUP BY 1, 2"""
    ),
)(lambda t: m.statuses_by_day(t.marts, FILTERS))

PERIOD = m.Filters(period=("1997-01-01", "1999-12-31"))
query(
    "q36_conversion_in_period",
    sparse(
        """SELECT sum(CAST(has_order AS INTEGER))::DOUBLE / count(*) AS conversion FROM sfo
        WHERE is_mature AND registration_date >= '1997-01-01' AND registration_date < '2000-01-01'"""
    ),
)(lambda t: m.conversion(t.sparse_marts, PERIOD))
query(
    "q36_retention_in_period",
    clock(
        """SELECT cohort_week, 'нед. ' || lpad(CAST(weeks_since_signup AS VARCHAR), 2, '0') AS week,
        avg(retention_rate) AS retention FROM cohort_grid
        WHERE is_mature AND cohort_week_date BETWEEN '2024-01-02' AND '2024-01-20' GROUP BY 1, 2"""
    ),
)(lambda t: m.retention(t.clock_marts, m.Filters(period=("2024-01-02", "2024-01-20"))))
query(
    "q36_rejected_share_in_period",
    raw_all(
        """SELECT sum(invalid_rows)::DOUBLE / sum(total_rows)::DOUBLE AS rejected_share FROM dqm
        WHERE load_date BETWEEN '1997-01-01' AND '1999-12-31'"""
    ),
)(lambda t: m.rejected_share(t.dq_metrics, PERIOD))

query(
    "q37_conversion_finding",
    sparse(
        """SELECT round(sum(CAST(has_order AS INTEGER))::DOUBLE * 100 / count(*), 1) AS conversion_pct,
        count(*) AS total, sum(CAST(has_order AS INTEGER))::BIGINT AS converted,
        (count(*) - sum(CAST(has_order AS INTEGER)))::BIGINT AS rest FROM sfo WHERE is_mature"""
    ),
)(lambda t: m.conversion_finding(t.sparse_marts))
query(
    "q38_cancellation_reason_finding",
    business(
        """SELECT round(count(*) FILTER (WHERE cancellation_reason_ru = 'Не оплачен вовремя') * 100
          / count(*), 1) AS share_pct FROM od WHERE is_mature AND cancelled_at IS NOT NULL"""
    ),
)(lambda t: m.cancellation_reason_finding(t.marts))
query(
    "q39_city_share_finding",
    business(
        f"""SELECT round(sum(CASE WHEN city = 'NATION_1' AND {PAID} THEN amount_kopecks ELSE 0 END)::DOUBLE * 100
          / sum(CASE WHEN {PAID} THEN amount_kopecks ELSE 0 END)::DOUBLE, 1) AS share_pct
        FROM od WHERE is_payment_settled"""
    ),
)(lambda t: m.city_share_finding(t.marts, city="NATION_1"))
query(
    "q40_data_period", business(f"SELECT min({DAY}) AS first_day, max({DAY}) AS last_day FROM od")
)(lambda t: m.data_period(t.marts))
query(
    "q41_status_histogram", business("SELECT status, count(*) AS orders FROM mo GROUP BY status")
)(lambda t: m.status_histogram(t.version_marts))
query(
    "q41_version_symptom",
    business(
        """SELECT count(*) AS rows_total, count(DISTINCT payment_id) AS keys_total,
        count(*) > count(DISTINCT payment_id) AS unresolved FROM p_all"""
    ),
)(lambda t: m.has_unresolved_versions(t.payments, "payment_id"))
query(
    "q42_legacy_success_share",
    business(
        """SELECT count(*) FILTER (WHERE status = 'success') / count(*) FILTER (WHERE status IN ('success', 'failed'))
          AS legacy_share, count(*) FILTER (WHERE attempt_succeeded) / count(*) AS success_share FROM mp"""
    ),
)(lambda t: m.legacy_success_share(t.marts))
