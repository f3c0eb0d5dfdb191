"""M01 to M17."""

from dayledger.catalog.oracle import business, case, clock, raw_all, registered
from dayledger.catalog.registry import query
from dayledger.fixed_values import CHANNEL_LABELS, ENTITY_LABELS

query(
    "m01_customers",
    business(
        f"""SELECT *, {case("acquisition_channel", CHANNEL_LABELS)} AS acquisition_channel_ru FROM (
        SELECT * FROM (
          SELECT * FROM c UNION ALL
          SELECT s_suppkey, {registered("s_suppkey")}, n_name, 'referral', lower(s_name) || '@example.org',
                 CAST({registered("s_suppkey")} AS DATE) + 1
          FROM supplier JOIN nation ON s_nationkey = n_nationkey)
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY load_date DESC) = 1)"""
    ),
)(lambda t: t.version_marts.customers)

query(
    "m02_orders",
    business(
        """SELECT * REPLACE (list_max([created_at, paid_at, shipped_at, ready_for_pickup_at, delivered_at,
        cancelled_at, returned_at, refunded_at])::DATE AS load_date) FROM mo"""
    ),
)(lambda t: t.version_marts.orders)

query("m03_payments", business("SELECT * FROM mp"))(lambda t: t.marts.payments)

query(
    "m04_order_funnel_stages",
    business(
        """SELECT 'Создано' AS stage, 1 AS stage_order, count(*) AS cnt FROM mo WHERE is_mature
        UNION ALL SELECT 'Оплачено', 2, count(paid_at) FROM mo WHERE is_mature
        UNION ALL SELECT 'Отправлено', 3, count(shipped_at) FROM mo WHERE is_mature
        UNION ALL SELECT 'Готово к выдаче', 4, count(ready_for_pickup_at) FROM mo WHERE is_mature
        UNION ALL SELECT 'Доставлено', 5, count(delivered_at) FROM mo WHERE is_mature"""
    ),
)(lambda t: t.marts.order_funnel_stages)

query("m05_orders_with_customer_dim", business("SELECT * FROM od"))(
    lambda t: t.marts.orders_with_customer_dim
)
query("m06_orders_by_hour_dow", clock("SELECT * FROM hour_grid"))(
    lambda t: t.clock_marts.orders_by_hour_dow
)
query("m07_customer_first_order", clock("SELECT * FROM first_order"))(
    lambda t: t.clock_marts.customer_first_order
)

SPARSE_FIRST_ORDER = f"""
everyone AS (
  SELECT customer_id, registration_date, city, acquisition_channel_ru FROM mc
  UNION ALL
  SELECT -1 - s_suppkey, {registered("s_suppkey")}, n_name, '{CHANNEL_LABELS["referral"]}'
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
sfo AS (
  SELECT everyone.customer_id, registration_date, city, acquisition_channel_ru,
         count(order_id) AS orders_count, count(order_id) > 0 AS has_order,
         count(CASE WHEN created_at >= registration_date
                     AND created_at < registration_date + INTERVAL 30 DAY THEN 1 END) > 0
           AS converted_within_window,
         min(created_at) AS first_order_at,
         date_diff('day', CAST(registration_date AS DATE), CAST(min(created_at) AS DATE)) AS days_to_first_order,
         registration_date < (SELECT max(created_at) FROM o) - INTERVAL 30 DAY AS is_mature
  FROM everyone LEFT JOIN o ON o.customer_id = everyone.customer_id GROUP BY 1, 2, 3, 4)
"""


def sparse(body: str) -> str:
    return business("").rstrip() + "," + SPARSE_FIRST_ORDER + body


query("m07_customer_first_order_few_orders", sparse("SELECT * FROM sfo"))(
    lambda t: t.sparse_marts.customer_first_order
)
query(
    "m08_first_order_delay_distribution",
    sparse(
        """SELECT days_to_first_order, count(*) AS customers FROM sfo
        WHERE is_mature AND days_to_first_order >= 0 GROUP BY 1"""
    ),
)(lambda t: t.sparse_marts.first_order_delay_distribution)

query(
    "m09_payment_retries_distribution",
    business(
        """SELECT attempts, count(*) AS orders_count
        FROM (SELECT order_id, count(*) AS attempts FROM mp GROUP BY order_id) GROUP BY attempts"""
    ),
)(lambda t: t.marts.payment_retries_distribution)

query("m10_customer_cohort_retention", clock("SELECT * FROM cohort_grid"))(
    lambda t: t.clock_marts.customer_cohort_retention
)

query(
    "m11_refund_processing_times",
    business(
        """SELECT order_id, refunded_at,
               CASE WHEN cancelled_at IS NOT NULL THEN 'Отмена' ELSE 'Возврат товара' END AS refund_kind,
               date_diff('second', coalesce(cancelled_at, returned_at), refunded_at) AS duration_seconds
        FROM mo WHERE refunded_at IS NOT NULL AND coalesce(cancelled_at, returned_at) IS NOT NULL
          AND refunded_at >= coalesce(cancelled_at, returned_at)"""
    ),
)(lambda t: t.marts.refund_processing_times)

query("m12_dq_reason_breakdown", raw_all("SELECT * FROM reasons"))(
    lambda t: t.marts.dq_reason_breakdown
)
query(
    "m13_quarantine_volume",
    raw_all(
        f"""SELECT load_date, {case("entity", ENTITY_LABELS)} AS entity, count(*) AS quarantined_rows
        FROM quarantine WHERE dq_reason <> '' GROUP BY 1, 2"""
    ),
)(lambda t: t.marts.quarantine_volume)

STAGE_DURATIONS = """
SELECT order_id, '1. Оплата' AS stage, date_diff('second', created_at, paid_at) AS duration_seconds
FROM mo WHERE paid_at IS NOT NULL
UNION ALL SELECT order_id, '2. Отправка', date_diff('second', paid_at, shipped_at)
FROM mo WHERE paid_at IS NOT NULL AND shipped_at IS NOT NULL
UNION ALL SELECT order_id, '3. Доставка', date_diff('second', shipped_at, ready_for_pickup_at)
FROM mo WHERE shipped_at IS NOT NULL AND ready_for_pickup_at IS NOT NULL
UNION ALL SELECT order_id, '4. Получение', date_diff('second', ready_for_pickup_at, delivered_at)
FROM mo WHERE ready_for_pickup_at IS NOT NULL AND delivered_at IS NOT NULL"""
query("m14_order_stage_durations", business(STAGE_DURATIONS))(lambda t: t.marts.order_stage_durations)

NUMBERED = """SELECT order_id, customer_id, created_at, amount_kopecks, status, status_ru,
       CAST(row_number() OVER (PARTITION BY customer_id ORDER BY created_at, order_id) AS INTEGER) AS order_seq
FROM {orders}"""
query("m15_orders_with_sequence", business(NUMBERED.format(orders="mo")))(
    lambda t: t.marts.orders_with_sequence
)
query("m15_orders_with_sequence_by_clock", clock(NUMBERED.format(orders="co")))(
    lambda t: t.clock_marts.orders_with_sequence
)
query(
    "m16_customer_order_counts",
    business("SELECT customer_id, count(*) AS orders_count FROM mo GROUP BY customer_id"),
)(lambda t: t.marts.customer_order_counts)

FRESHNESS = """SELECT entity, max(load_date) AS last_load_date,
       date_diff('hour', max(loaded_at), TIMESTAMP '2001-09-01 00:30:00') AS hours_since_load
FROM commits GROUP BY entity"""
query("m17_load_freshness", business(FRESHNESS))(lambda t: t.marts.load_freshness)
