"""The driver-table views once more in ANSI SQL, for the side-by-side comparison.

Written independently of the Spark plans: versions are not resolved here but the final
state is computed directly, duplicates are counted with window functions, and dense
grids are cross joins of their axes.
"""

from __future__ import annotations

from dayledger import fixed_values as fixed
from dayledger.sources.driver_tables import CLOCK_CHANNELS, LOAD_DATE


def case(column: str, labels: dict[str, str]) -> str:
    branches = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in labels.items())
    return f"CASE {column} {branches} ELSE {column} END"


def listed(words) -> str:
    return ", ".join(f"'{word}'" for word in words)


def registered(key: str) -> str:
    return f"(TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST({key} * 37 % 2190 AS INTEGER)))"


STATE = """CASE WHEN refunded_at IS NOT NULL THEN 'refunded'
         WHEN cancelled_at IS NOT NULL THEN 'cancelled'
         WHEN returned_at IS NOT NULL THEN 'returned'
         WHEN delivered_at IS NOT NULL THEN 'delivered'
         WHEN ready_for_pickup_at IS NOT NULL THEN 'ready_for_pickup'
         WHEN shipped_at IS NOT NULL THEN 'shipped'
         WHEN paid_at IS NOT NULL THEN 'paid' ELSE 'new' END"""
REASON = """CASE WHEN cancelled_at IS NULL THEN NULL
         WHEN paid_at IS NULL THEN 'not_paid_in_time'
         WHEN ready_for_pickup_at IS NOT NULL THEN 'not_picked_up_in_time'
         ELSE 'cancelled_by_customer_after_payment' END"""
METHOD = "CASE {n} % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'sbp' WHEN 2 THEN 'mir_pay' ELSE 'cash' END"

ENTITIES = f"""
c AS (
  SELECT c_custkey AS customer_id, {registered("c_custkey")} AS registration_date, n_name AS city,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'telegram_ads' WHEN 'BUILDING' THEN 'yandex_direct'
           WHEN 'FURNITURE' THEN 'social' WHEN 'HOUSEHOLD' THEN 'organic' ELSE c_mktsegment END
           AS acquisition_channel,
         lower(c_name) || '@example.org' AS email,
         CAST({registered("c_custkey")} AS DATE) AS load_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
mc AS (SELECT *, {case("acquisition_channel", fixed.CHANNEL_LABELS)} AS acquisition_channel_ru FROM c),
ranked_lines AS (
  SELECT o_orderkey, l_returnflag, l_shipdate + to_hours(l_linenumber) AS shipped_moment,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey,
           l_suppkey, l_extendedprice) AS place
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_shipdate >= o_orderdate),
milestones AS (
  SELECT o_orderkey AS mk,
         max(shipped_moment) FILTER (WHERE place = 1) AS paid_at,
         max(shipped_moment) FILTER (WHERE place = 2) AS shipped_at,
         max(shipped_moment) FILTER (WHERE place = 3) AS ready_for_pickup_at,
         max(shipped_moment) FILTER (WHERE place = 4) AS delivered_at,
         max(shipped_moment) FILTER (WHERE place = 5 AND l_returnflag = 'R') AS returned_at
  FROM ranked_lines GROUP BY o_orderkey),
moments1 AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS created_at,
         o_totalprice, o_orderpriority, o_orderstatus,
         CAST(round(o_totalprice * 100) AS BIGINT) AS amount_kopecks,
         paid_at, shipped_at, ready_for_pickup_at, delivered_at, returned_at,
         CASE WHEN delivered_at IS NULL AND o_orderstatus = 'F'
              THEN coalesce(ready_for_pickup_at, shipped_at, paid_at, o_orderdate) + INTERVAL 1 DAY END
           AS cancelled_at
  FROM orders LEFT JOIN milestones ON mk = o_orderkey),
moments AS (
  SELECT *, CASE WHEN cancelled_at IS NOT NULL
              THEN CASE WHEN paid_at IS NOT NULL THEN cancelled_at + INTERVAL 2 DAY END
              WHEN o_orderpriority <> '5-LOW' THEN returned_at + INTERVAL 3 DAY END AS refunded_at
  FROM moments1),
o_wide AS (
  SELECT *, {STATE} AS status, {REASON} AS cancellation_reason,
         CASE WHEN paid_at IS NOT NULL THEN {METHOD.format(n="order_id")} END AS payment_method,
         CAST(created_at AS DATE) AS load_date
  FROM moments),
o AS (
  SELECT order_id, customer_id, created_at, amount_kopecks, status, cancellation_reason,
         payment_method, paid_at, shipped_at, ready_for_pickup_at, delivered_at, cancelled_at,
         returned_at, refunded_at, load_date FROM o_wide),
mo AS (
  SELECT *, {case("status", fixed.ORDER_STATUS_LABELS)} AS status_ru,
         {case("cancellation_reason", fixed.CANCELLATION_LABELS)} AS cancellation_reason_ru,
         created_at < (SELECT max(created_at) FROM o) - INTERVAL 34 DAY AS is_mature,
         created_at < (SELECT max(created_at) FROM o) - INTERVAL 2 DAY AS is_payment_settled
  FROM o),
od AS (
  SELECT mo.order_id, mo.customer_id, created_at, amount_kopecks, status, status_ru, paid_at,
         shipped_at, ready_for_pickup_at, delivered_at, cancelled_at, cancellation_reason,
         cancellation_reason_ru, returned_at, refunded_at, is_mature, is_payment_settled,
         coalesce(city, '') AS city, coalesce(acquisition_channel, '') AS acquisition_channel,
         coalesce(acquisition_channel_ru, '') AS acquisition_channel_ru
  FROM mo LEFT JOIN mc ON mc.customer_id = mo.customer_id),
p_all AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS payment_id,
         l_orderkey AS order_id, l_shipdate AS payment_date,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_kopecks,
         CASE WHEN l_linenumber <= 4 THEN {METHOD.format(n="(l_linenumber - 1)")} ELSE 'voucher' END
           AS payment_method,
         CASE l_returnflag WHEN 'N' THEN 'success' WHEN 'A' THEN 'failed' ELSE 'refunded' END AS status,
         CAST(l_shipdate AS DATE) AS load_date
  FROM lineitem),
p AS (
  SELECT * FROM p_all QUALIFY row_number() OVER (PARTITION BY payment_id
    ORDER BY load_date DESC, payment_date DESC, amount_kopecks DESC, status DESC) = 1),
mp AS (
  SELECT *, {case("status", fixed.PAYMENT_STATUS_LABELS)} AS status_ru,
         {case("payment_method", fixed.PAYMENT_METHOD_LABELS)} AS payment_method_ru,
         status IN ('success', 'refunded') AS attempt_succeeded, status = 'refunded' AS is_refunded
  FROM p),
commits AS (
  SELECT load_date, 'customers' AS entity, count(*) AS rows,
         load_date + INTERVAL 1 DAY + INTERVAL 3 HOUR AS loaded_at FROM c GROUP BY load_date
  UNION ALL
  SELECT load_date, 'orders', count(*), load_date + INTERVAL 1 DAY + INTERVAL 3 HOUR
  FROM o GROUP BY load_date)
"""

CLOCK = f"""
cc AS (
  SELECT user_id AS customer_id, registration_date, n_name AS city,
         [{listed(CLOCK_CHANNELS)}][user_id % {len(CLOCK_CHANNELS)} + 1] AS acquisition_channel
  FROM (SELECT user_id, min(date_trunc('second', ts)) AS registration_date FROM events
        WHERE event_type = 'signup' GROUP BY user_id) s JOIN nation ON user_id % 25 = n_nationkey),
mcc AS (SELECT *, {case("acquisition_channel", fixed.CHANNEL_LABELS)} AS acquisition_channel_ru FROM cc),
co AS (
  SELECT event_id AS order_id, user_id AS customer_id, date_trunc('second', ts) AS created_at,
         CAST(round(value * 100) AS BIGINT) AS amount_kopecks, 'new' AS status, 'Создан' AS status_ru
  FROM events WHERE event_type = 'purchase'),
cod AS (
  SELECT co.*, coalesce(city, '') AS city, coalesce(acquisition_channel_ru, '') AS acquisition_channel_ru
  FROM co LEFT JOIN mcc ON mcc.customer_id = co.customer_id),
first_order AS (
  SELECT mcc.customer_id, registration_date, city, acquisition_channel_ru,
         count(order_id) AS orders_count, count(order_id) > 0 AS has_order,
         count(CASE WHEN created_at >= registration_date
                     AND created_at < registration_date + INTERVAL 30 DAY THEN 1 END) > 0
           AS converted_within_window,
         min(created_at) AS first_order_at,
         date_diff('day', CAST(registration_date AS DATE), CAST(min(created_at) AS DATE)) AS days_to_first_order,
         registration_date < (SELECT max(created_at) FROM co) - INTERVAL 30 DAY AS is_mature
  FROM mcc LEFT JOIN co ON co.customer_id = mcc.customer_id GROUP BY 1, 2, 3, 4),
hour_axis AS (SELECT unnest(range(24)) AS hour_of_day),
day_axis AS (
  SELECT [{listed(fixed.WEEKDAY_LABELS)}][isodow(d)] AS dow_label, count(*) AS days
  FROM (SELECT unnest(generate_series((SELECT min(created_at)::DATE FROM co),
                                      (SELECT max(created_at)::DATE FROM co), INTERVAL 1 DAY)) AS d)
  GROUP BY 1),
grid_cells AS (
  SELECT [{listed(fixed.WEEKDAY_LABELS)}][isodow(created_at)] AS dow_label, hour(created_at) AS hour_of_day,
         city, acquisition_channel_ru, count(*) AS orders FROM cod GROUP BY 1, 2, 3, 4),
hour_grid AS (
  SELECT d.dow_label, CAST(h.hour_of_day AS INTEGER) AS hour_of_day, coalesce(city, '') AS city,
         coalesce(acquisition_channel_ru, '') AS acquisition_channel_ru, coalesce(orders, 0) AS orders, days
  FROM day_axis d CROSS JOIN hour_axis h
  LEFT JOIN grid_cells g ON g.dow_label = d.dow_label AND g.hour_of_day = h.hour_of_day),
cohorts AS (
  SELECT customer_id, CAST(date_trunc('week', registration_date) AS DATE) AS cohort_week_date FROM mcc),
cohort_sizes AS (SELECT cohort_week_date, count(*) AS cohort_size FROM cohorts GROUP BY 1),
activity AS (
  SELECT cohort_week_date,
         date_diff('day', cohort_week_date, CAST(date_trunc('week', created_at) AS DATE)) // 7 AS weeks_since_signup,
         count(DISTINCT co.customer_id) AS active_customers
  FROM cohorts JOIN co ON co.customer_id = cohorts.customer_id GROUP BY 1, 2),
week_axis AS (SELECT unnest(range((SELECT max(weeks_since_signup) FROM activity) + 1)) AS weeks_since_signup),
cohort_grid AS (
  SELECT strftime(s.cohort_week_date, '%Y-%m-%d') AS cohort_week, s.cohort_week_date,
         CAST(x.weeks_since_signup AS INTEGER) AS weeks_since_signup, cohort_size,
         coalesce(active_customers, 0) AS active_customers,
         coalesce(active_customers, 0) / cohort_size AS retention_rate,
         CAST(s.cohort_week_date + to_days(CAST((x.weeks_since_signup + 1) * 7 AS INTEGER)) AS TIMESTAMP)
           <= (SELECT max(created_at) FROM co) AS is_mature
  FROM cohort_sizes s CROSS JOIN week_axis x
  LEFT JOIN activity a ON a.cohort_week_date = s.cohort_week_date AND a.weeks_since_signup = x.weeks_since_signup)
"""


def _format(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S')"


def _code(condition: str, code: str) -> str:
    return f"CASE WHEN {condition} THEN '{code}' END"


HISTORY = f"""SELECT DISTINCT CAST(customer_id AS VARCHAR) AS hid FROM c
           WHERE load_date >= DATE '{LOAD_DATE}' - 365 AND load_date < DATE '{LOAD_DATE}'"""
NO_HISTORY = "SELECT CAST(NULL AS VARCHAR) AS hid WHERE false"
CUSTOMERS = "SELECT CAST(c_custkey AS VARCHAR) AS cid FROM customer"
ACCEPTED_CUSTOMERS = "SELECT DISTINCT customer_id AS cid FROM tc WHERE dq_reason = ''"
ORDERS = "SELECT CAST(o_orderkey AS VARCHAR) AS oid, o_orderdate AS oat FROM orders"
ACCEPTED_ORDERS = "SELECT order_id AS oid, min(created_at) AS oat FROM tor WHERE dq_reason = '' GROUP BY order_id"


def customers_part(history: str = HISTORY) -> str:
    return f"""
rc AS (
  SELECT CASE WHEN c_acctbal < -900 THEN '  ' WHEN c_acctbal < -800 THEN NULL
              ELSE CAST(c_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN c_acctbal > 9800 THEN NULL ELSE {registered("c_custkey")} END AS registration_date,
         n_name AS city, c_mktsegment AS acquisition_channel, c_name AS email,
         CAST({registered("c_custkey")} AS DATE) AS load_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT CAST(s_suppkey AS VARCHAR), {registered("s_suppkey")}, n_name, 'referral', s_name,
         CAST({registered("s_suppkey")} AS DATE)
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
rc_ids AS ({history}),
ec AS (SELECT rc.*, count(*) OVER (PARTITION BY customer_id) AS copies, hid
       FROM rc LEFT JOIN rc_ids ON hid = customer_id),
codes_c AS (SELECT *,
  {_code("customer_id IS NULL OR trim(customer_id) = ''", "CUSTOMER_ID_EMPTY")} AS d01,
  {_code("copies > 1", "CUSTOMER_ID_DUPLICATE_IN_LOAD")} AS d02,
  {_code("hid IS NOT NULL", "CUSTOMER_ID_DUPLICATE_IN_HISTORY")} AS d03,
  {_code("registration_date IS NULL", "REGISTRATION_DATE_INVALID")} AS d04 FROM ec),
tc AS (SELECT *, concat_ws(' | ', d01, d02, d03, d04) AS dq_reason FROM codes_c)
"""


def orders_part(parents: str = CUSTOMERS) -> str:
    return f"""
ro AS (
  SELECT CASE WHEN o_totalprice < 2000 THEN '' ELSE CAST(order_id AS VARCHAR) END AS order_id,
         CASE WHEN o_totalprice > 100000 AND o_totalprice < 120000 THEN '-' || CAST(customer_id AS VARCHAR)
              WHEN o_totalprice < 499000 THEN CAST(customer_id AS VARCHAR) END AS customer_id,
         CASE WHEN o_totalprice > 498000 AND o_totalprice < 499000 THEN NULL ELSE created_at END AS created_at,
         CAST(round((o_totalprice - 3000) * 100) AS BIGINT) AS amount_kopecks,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN ' ' || upper(status)
              WHEN o_totalprice > 496000 AND o_totalprice < 498000 THEN 'lost'
              WHEN o_totalprice > 495000 AND o_totalprice < 496000 THEN NULL ELSE status END AS status,
         CASE WHEN o_orderpriority = '2-HIGH' AND status = 'cancelled' THEN NULL
              WHEN o_orderpriority = '4-NOT SPECIFIED' AND status = 'paid' THEN 'not_paid_in_time'
              ELSE cancellation_reason END AS cancellation_reason,
         payment_method, paid_at, shipped_at, ready_for_pickup_at, delivered_at, cancelled_at, returned_at,
         CASE WHEN o_orderpriority = '5-LOW' THEN cancelled_at - INTERVAL 1 HOUR ELSE refunded_at END AS refunded_at,
         load_date
  FROM o_wide, range(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 2 ELSE 1 END) AS copy(n)),
ro_parents AS ({parents}),
eo AS (SELECT ro.*, count(*) OVER (PARTITION BY order_id) AS copies, cid
       FROM ro LEFT JOIN ro_parents ON cid = customer_id),
codes_o AS (SELECT *,
  {_code("order_id IS NULL OR trim(order_id) = ''", "ORDER_ID_EMPTY")} AS d05,
  {_code("copies > 1", "ORDER_ID_DUPLICATE_IN_LOAD")} AS d06,
  {_code("customer_id IS NULL OR trim(customer_id) = ''", "CUSTOMER_ID_EMPTY")} AS d07,
  {_code("cid IS NULL", "CUSTOMER_NOT_FOUND")} AS d08,
  {_code("created_at IS NULL", "CREATED_AT_INVALID")} AS d09,
  {_code("amount_kopecks IS NULL OR amount_kopecks <= 0", "ORDER_AMOUNT_INVALID")} AS d10,
  {_code(f"status IS NULL OR trim(status) = '' OR lower(trim(status)) NOT IN ({listed(fixed.ORDER_STATUSES)})",
         "ORDER_STATUS_INVALID")} AS d11,
  {_code("(cancellation_reason IS NOT NULL AND lower(trim(status)) NOT IN ('cancelled', 'refunded'))"
         " OR (lower(trim(status)) = 'cancelled' AND cancellation_reason IS NULL)",
         "CANCELLATION_REASON_INCONSISTENT")} AS d12,
  {_code("refunded_at < cancelled_at OR refunded_at < returned_at", "REFUND_TIMELINE_INVALID")} AS d13
  FROM eo),
tor AS (SELECT *, concat_ws(' | ', d05, d06, d07, d08, d09, d10, d11, d12, d13) AS dq_reason FROM codes_o)
"""


def payments_part(parents: str = ORDERS) -> str:
    return f"""
rp AS (
  SELECT CASE WHEN l_quantity = 2 AND l_discount = 0 THEN ' '
              ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS payment_id,
         CASE WHEN l_quantity = 4 AND l_discount = 0 THEN '-' || CAST(l_orderkey AS VARCHAR)
              WHEN l_quantity = 3 AND l_discount = 0 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS order_id,
         CASE WHEN l_quantity = 1 THEN NULL ELSE l_shipdate END AS payment_date,
         CAST(round((l_extendedprice - 1000) * 100) AS BIGINT) AS amount_kopecks, 'card' AS payment_method,
         CASE WHEN l_returnflag = 'N' THEN 'success' WHEN l_returnflag = 'A' THEN 'Failed '
              WHEN l_quantity > 45 THEN 'chargeback' ELSE 'refunded' END AS status,
         CAST(l_shipdate AS DATE) AS load_date
  FROM lineitem),
rp_parents AS ({parents}),
ep AS (SELECT rp.*, count(*) OVER (PARTITION BY payment_id) AS copies, oid, oat
       FROM rp LEFT JOIN rp_parents ON oid = order_id),
codes_p AS (SELECT *,
  {_code("payment_id IS NULL OR trim(payment_id) = ''", "PAYMENT_ID_EMPTY")} AS d14,
  {_code("copies > 1", "PAYMENT_ID_DUPLICATE_IN_LOAD")} AS d15,
  {_code("order_id IS NULL OR trim(order_id) = ''", "ORDER_ID_EMPTY")} AS d16,
  {_code("oid IS NULL", "ORDER_NOT_FOUND")} AS d17,
  {_code("payment_date IS NULL", "PAYMENT_DATE_INVALID")} AS d18,
  {_code("amount_kopecks IS NULL OR amount_kopecks <= 0", "PAYMENT_AMOUNT_INVALID")} AS d19,
  {_code(f"status IS NULL OR trim(status) = '' OR lower(trim(status)) NOT IN ({listed(fixed.PAYMENT_STATUSES)})",
         "PAYMENT_STATUS_INVALID")} AS d20,
  {_code("payment_date < oat", "PAYMENT_BEFORE_ORDER")} AS d21 FROM ep),
tp AS (SELECT *, concat_ws(' | ', d14, d15, d16, d17, d18, d19, d20, d21) AS dq_reason FROM codes_p)
"""


REJECTS = f"""
quarantine AS (
  SELECT 'customers' AS entity, load_date, dq_reason FROM tc
  UNION ALL SELECT 'orders', load_date, dq_reason FROM tor
  UNION ALL SELECT 'payments', load_date, dq_reason FROM tp),
dqm AS (
  SELECT load_date, entity, count(*) FILTER (WHERE dq_reason = '') AS valid_rows,
         count(*) FILTER (WHERE dq_reason <> '') AS invalid_rows, count(*) AS total_rows
  FROM quarantine GROUP BY load_date, entity),
split_reasons AS (
  SELECT entity, load_date, unnest(string_split(dq_reason, ' | ')) AS code FROM quarantine WHERE dq_reason <> ''),
reasons AS (
  SELECT {case("code", fixed.REASON_LABELS)} AS reason, load_date, count(*) AS quarantined_rows
  FROM split_reasons GROUP BY 1, 2)
"""


def over(body: str, *parts: str) -> str:
    """A statement over the named groups of views."""
    return "WITH " + ",".join(part.strip("\n") for part in parts) + "\n" + body


def business(body: str) -> str:
    return over(body, ENTITIES)


def clock(body: str) -> str:
    return over(body, CLOCK)


def raw_customers(body: str) -> str:
    return over(body, ENTITIES, customers_part())


def raw_orders(body: str) -> str:
    return over(body, ENTITIES, orders_part())


def raw_payments(body: str) -> str:
    return over(body, payments_part())


def raw_all(body: str) -> str:
    return over(body, ENTITIES, customers_part(), orders_part(), payments_part(), REJECTS)


def one_day(body: str) -> str:
    """The whole raw view as a single first day: rejected parents reject their children."""
    return over(
        body,
        ENTITIES,
        customers_part(NO_HISTORY),
        orders_part(ACCEPTED_CUSTOMERS),
        payments_part(ACCEPTED_ORDERS),
        REJECTS,
    )
