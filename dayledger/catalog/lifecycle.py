"""R01 to R06."""

from pyspark.sql import functions as F

from dayledger.catalog.oracle import business, listed, raw_all, registered
from dayledger.catalog.registry import query
from dayledger.fixed_values import (
    AWAITING_REFUND_STATUSES,
    DEFECT_CODES,
    MOVING_STATUSES,
)
from dayledger.functions.buckets import stable_bucket
from dayledger.operators.lifecycle import overdue_orders
from dayledger.operators.reconcile import reconcile
from dayledger.operators.series import calendar, day_type
from dayledger.operators.versions import known_customers, open_orders

AS_OF = "1999-06-30"
LOOKBACK = 400
MILESTONES = ("paid_at", "shipped_at", "ready_for_pickup_at", "delivered_at", "cancelled_at",
              "returned_at", "refunded_at")

# The state of every order as known on AS_OF, from its final milestones, for orders that
# changed inside the lookback window.
_KNOWN = ", ".join(f"CASE WHEN CAST({c} AS DATE) <= DATE '{AS_OF}' THEN {c} END AS {c}" for c in MILESTONES)
AS_KNOWN = f"""SELECT *, CASE WHEN refunded_at IS NOT NULL THEN 'refunded' WHEN cancelled_at IS NOT NULL THEN 'cancelled'
  WHEN returned_at IS NOT NULL THEN 'returned' WHEN delivered_at IS NOT NULL THEN 'delivered'
  WHEN ready_for_pickup_at IS NOT NULL THEN 'ready_for_pickup' WHEN shipped_at IS NOT NULL THEN 'shipped'
  WHEN paid_at IS NOT NULL THEN 'paid' ELSE 'new' END AS status,
  CAST(list_max([created_at, {", ".join(MILESTONES)}]) AS DATE) AS load_date
  FROM (SELECT order_id, created_at, {_KNOWN} FROM moments WHERE CAST(created_at AS DATE) <= DATE '{AS_OF}')"""


@query(
    "r01_open_orders",
    business(
        f"""SELECT order_id, status, load_date FROM ({AS_KNOWN})
        WHERE load_date >= DATE '{AS_OF}' - {LOOKBACK}
          AND (status IN ({listed(MOVING_STATUSES)})
               OR (status IN ({listed(AWAITING_REFUND_STATUSES)}) AND paid_at IS NOT NULL))"""
    ),
)
def _(t):
    return open_orders(t.order_versions, AS_OF, LOOKBACK).select("order_id", "status", "load_date")


@query(
    "r02_known_customers",
    business(
        f"""SELECT customer_id, city, acquisition_channel, load_date FROM c
        WHERE registration_date <= TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY
        UNION ALL SELECT s_suppkey, n_name, 'referral', CAST({registered("s_suppkey")} AS DATE) + 1
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        WHERE {registered("s_suppkey")} <= TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY
          AND s_suppkey NOT IN (SELECT customer_id FROM c)"""
    ),
)
def _(t):
    known = known_customers(t.customer_versions, AS_OF)
    return known.select("customer_id", "city", "acquisition_channel", "load_date")


@query(
    "r03_overdue_orders",
    business(
        f"""SELECT * FROM (
        SELECT order_id, status, CASE status WHEN 'new' THEN created_at + INTERVAL 24 HOUR
               WHEN 'ready_for_pickup' THEN ready_for_pickup_at + INTERVAL 7 DAY END AS due_at,
               CASE status WHEN 'new' THEN 'not_paid_in_time' ELSE 'not_picked_up_in_time' END AS overdue_reason
        FROM mo) WHERE due_at <= TIMESTAMP '{AS_OF} 00:00:00'"""
    ),
)
def _(t):
    return overdue_orders(t.marts.orders, f"{AS_OF} 00:00:00")


_HOLIDAY = """(strftime({d}, '%m-%d') IN ('01-01', '01-02', '01-03', '01-04', '01-05', '01-06', '01-07', '01-08',
  '02-23', '03-08', '05-01', '05-09', '06-12', '11-04'))"""
_ON = {n: _HOLIDAY.format(d=f"(day - {n})") for n in range(3)}


@query(
    "r04_calendar_day_type",
    business(
        f"""SELECT day, CASE
          WHEN strftime(day, '%m-%d') = '11-11' THEN 'promo'
          WHEN month(day) = 11 AND isodow(day) = 5 AND month(day + 7) = 12 THEN 'promo'
          WHEN {_ON[0]} THEN 'holiday'
          WHEN isodow(day) = 1 AND ({_ON[1]} OR {_ON[2]}) THEN 'holiday'
          WHEN day(day) IN (5, 20) THEN 'payday' ELSE 'normal' END AS day_type
        FROM (SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders),
              (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS day)"""
    ),
)
def _(t):
    days = calendar(t.table("orders"), "o_orderdate")
    return days.select("day", day_type("day").alias("day_type"))


_BUCKET = "(CAST('0x' || substr(md5(CAST(customer_id AS VARCHAR)), {at}, 12) AS BIGINT) % 10000000) / 10000000.0::DOUBLE"


@query(
    "r05_stable_bucket",
    business(
        f"""SELECT customer_id, {_BUCKET.format(at=1)} AS first_bucket, {_BUCKET.format(at=13)} AS second_bucket
        FROM c"""
    ),
)
def _(t):
    as_text = t.customers.withColumn("id", F.col("customer_id").cast("string"))
    return as_text.select(
        "customer_id",
        stable_bucket("id").alias("first_bucket"),
        stable_bucket("id", slice_no=1).alias("second_bucket"),
    )


# Announced defects: what the raw view really contains per day and kind, except that
# suppliers' double ids were never announced.
EXPECTED = {
    "orders.invalid_status": (
        "raw_orders",
        "status IS NULL OR status = 'lost'",
        "SELECT load_date, count(*) AS n FROM ro WHERE status IS NULL OR status = 'lost' GROUP BY 1",
    ),
    "payments.missing_order_id": (
        "raw_payments",
        "order_id IS NULL",
        "SELECT load_date, count(*) AS n FROM rp WHERE order_id IS NULL GROUP BY 1",
    ),
    "payments.negative_amount": (
        "raw_payments",
        "amount_kopecks <= 0",
        "SELECT load_date, count(*) AS n FROM rp WHERE amount_kopecks <= 0 GROUP BY 1",
    ),
    "customers.null_customer_id": (
        "raw_customers",
        "customer_id IS NULL",
        "SELECT load_date, count(*) AS n FROM rc WHERE customer_id IS NULL GROUP BY 1",
    ),
}
_ANNOUNCED = " UNION ALL ".join(
    f"SELECT '{issue.split('.')[0]}' AS entity, '{DEFECT_CODES[issue]}' AS reason, load_date, n FROM ({sql})"
    for issue, (_, _, sql) in EXPECTED.items()
)


@query(
    "r06_reconcile",
    raw_all(
        f"""SELECT load_date, entity, reason, coalesce(n, 0)::BIGINT AS expected_rows,
        coalesce(k, 0)::BIGINT AS quarantined_rows, (coalesce(k, 0) - coalesce(n, 0))::BIGINT AS difference
        FROM (SELECT load_date, entity, reason, sum(n) AS n FROM ({_ANNOUNCED}) GROUP BY ALL)
        FULL JOIN (SELECT load_date, entity, code AS reason, count(*) AS k FROM split_reasons GROUP BY ALL)
        USING (load_date, entity, reason)"""
    ),
)
def _(t):
    expected = None
    for issue, (view, spoiled, _) in EXPECTED.items():
        counted = (
            getattr(t, view)
            .where(spoiled)
            .groupBy("load_date")
            .agg(F.count("*").alias("expected_rows"))
            .withColumn("issue_type", F.lit(issue))
        )
        expected = counted if expected is None else expected.unionByName(counted)
    quarantines = {e: t.quarantine(e) for e in ("customers", "orders", "payments")}
    return reconcile(expected, quarantines, DEFECT_CODES)
