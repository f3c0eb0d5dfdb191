"""One valid row per entity, one field changed at a time, the exact list of codes."""

from functools import reduce

import re

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.operators import quality
from dayledger.plans.day_gate import enriched_payments, tagged_payments, typed

VALID = {
    "customers": {
        "customer_id": "'c1'",
        "registration_date": "timestamp'2026-06-01 12:00:00'",
        "copies_in_load": "1L",
        "in_history": "CAST(NULL AS BOOLEAN)",
    },
    "orders": {
        "order_id": "'o1'",
        "customer_id": "'c1'",
        "created_at": "timestamp'2026-06-01 12:00:00'",
        "amount_kopecks": "150000L",
        "status": "'delivered'",
        "cancellation_reason": "CAST(NULL AS STRING)",
        "cancelled_at": "CAST(NULL AS TIMESTAMP)",
        "returned_at": "CAST(NULL AS TIMESTAMP)",
        "refunded_at": "CAST(NULL AS TIMESTAMP)",
        "copies_in_load": "1L",
        "customer_known": "true",
    },
    "payments": {
        "payment_id": "'p1'",
        "order_id": "'o1'",
        "payment_date": "timestamp'2026-06-01 12:00:00'",
        "amount_kopecks": "150000L",
        "status": "'success'",
        "copies_in_load": "1L",
        "order_known": "true",
        "order_created_at": "timestamp'2026-05-30 12:00:00'",
    },
}
NULL_TEXT = "CAST(NULL AS STRING)"
NULL_MOMENT = "CAST(NULL AS TIMESTAMP)"
NULL_LONG = "CAST(NULL AS BIGINT)"


CASES = [
    ("customers", {}, ""),
    ("customers", {"customer_id": "''"}, "CUSTOMER_ID_EMPTY"),
    ("customers", {"customer_id": "'   '"}, "CUSTOMER_ID_EMPTY"),
    ("customers", {"customer_id": NULL_TEXT}, "CUSTOMER_ID_EMPTY"),
    ("customers", {"copies_in_load": "2L"}, "CUSTOMER_ID_DUPLICATE_IN_LOAD"),
    ("customers", {"in_history": "true"}, "CUSTOMER_ID_DUPLICATE_IN_HISTORY"),
    ("customers", {"registration_date": NULL_MOMENT}, "REGISTRATION_DATE_INVALID"),
    (
        "customers",
        {"registration_date": NULL_MOMENT, "customer_id": "''", "copies_in_load": "2L"},
        "CUSTOMER_ID_EMPTY | CUSTOMER_ID_DUPLICATE_IN_LOAD | REGISTRATION_DATE_INVALID",
    ),
    ("orders", {}, ""),
    ("orders", {"order_id": "' '"}, "ORDER_ID_EMPTY"),
    ("orders", {"copies_in_load": "3L"}, "ORDER_ID_DUPLICATE_IN_LOAD"),
    (
        "orders",
        {"customer_id": NULL_TEXT, "customer_known": "CAST(NULL AS BOOLEAN)"},
        "CUSTOMER_ID_EMPTY | CUSTOMER_NOT_FOUND",
    ),
    ("orders", {"customer_known": "CAST(NULL AS BOOLEAN)"}, "CUSTOMER_NOT_FOUND"),
    ("orders", {"created_at": NULL_MOMENT}, "CREATED_AT_INVALID"),
    ("orders", {"amount_kopecks": "0L"}, "ORDER_AMOUNT_INVALID"),
    ("orders", {"amount_kopecks": "-1L"}, "ORDER_AMOUNT_INVALID"),
    ("orders", {"amount_kopecks": NULL_LONG}, "ORDER_AMOUNT_INVALID"),
    ("orders", {"amount_kopecks": "1L"}, ""),
    ("orders", {"status": "'lost'"}, "ORDER_STATUS_INVALID"),
    ("orders", {"status": "'  '"}, "ORDER_STATUS_INVALID"),
    ("orders", {"status": NULL_TEXT}, "ORDER_STATUS_INVALID"),
    ("orders", {"status": "' Delivered '"}, ""),
    ("orders", {"cancellation_reason": "'x'"}, "CANCELLATION_REASON_INCONSISTENT"),
    ("orders", {"cancellation_reason": "'x'", "status": "'Refunded'"}, ""),
    ("orders", {"status": "'cancelled'"}, "CANCELLATION_REASON_INCONSISTENT"),
    ("orders", {"status": "'Cancelled'", "cancellation_reason": "'x'"}, ""),
    # An unknown status leaves the reason rule undecided.
    ("orders", {"status": NULL_TEXT, "cancellation_reason": "'x'"}, "ORDER_STATUS_INVALID"),
    (
        "orders",
        {
            "refunded_at": "timestamp'2026-06-02 00:00:00'",
            "cancelled_at": "timestamp'2026-06-02 00:00:01'",
        },
        "REFUND_TIMELINE_INVALID",
    ),
    (
        "orders",
        {
            "refunded_at": "timestamp'2026-06-02 00:00:00'",
            "returned_at": "timestamp'2026-06-03 00:00:00'",
        },
        "REFUND_TIMELINE_INVALID",
    ),
    (
        "orders",
        {
            "refunded_at": "timestamp'2026-06-02 00:00:00'",
            "cancelled_at": "timestamp'2026-06-02 00:00:00'",
        },
        "",
    ),
    ("orders", {"cancelled_at": "timestamp'2026-06-02 00:00:00'"}, ""),
    ("payments", {}, ""),
    ("payments", {"payment_id": "''"}, "PAYMENT_ID_EMPTY"),
    ("payments", {"copies_in_load": "2L"}, "PAYMENT_ID_DUPLICATE_IN_LOAD"),
    (
        "payments",
        {
            "order_id": NULL_TEXT,
            "order_known": "CAST(NULL AS BOOLEAN)",
            "order_created_at": NULL_MOMENT,
        },
        "ORDER_ID_EMPTY | ORDER_NOT_FOUND",
    ),
    ("payments", {"payment_date": NULL_MOMENT}, "PAYMENT_DATE_INVALID"),
    ("payments", {"amount_kopecks": "0L"}, "PAYMENT_AMOUNT_INVALID"),
    ("payments", {"amount_kopecks": NULL_LONG}, "PAYMENT_AMOUNT_INVALID"),
    ("payments", {"status": "'chargeback'"}, "PAYMENT_STATUS_INVALID"),
    ("payments", {"status": "'SUCCESS '"}, ""),
    ("payments", {"order_created_at": "timestamp'2026-06-01 12:00:01'"}, "PAYMENT_BEFORE_ORDER"),
    ("payments", {"order_created_at": "timestamp'2026-06-01 12:00:00'"}, ""),
]


@pytest.fixture(scope="module")
def found(spark):
    """Codes of every case by position; all cases of an entity are rows of one table."""
    rules = {
        "customers": quality.customer_rules(),
        "orders": quality.order_rules(),
        "payments": quality.payment_rules(),
    }
    out = {}
    for entity, valid in VALID.items():
        rows = [
            spark.range(1).select(
                F.lit(n).alias("n"), *(F.expr(sql).alias(name) for name, sql in {**valid, **changes}.items())
            )
            for n, (of, changes, _) in enumerate(CASES)
            if of == entity
        ]
        tagged = quality.with_reasons(reduce(DataFrame.unionByName, rows), rules[entity])
        out |= {r["n"]: r["dq_reason"] for r in tagged.collect()}
    return out


@pytest.mark.parametrize("n", range(len(CASES)), ids=[f"{e}-{c}" for e, c, _ in CASES])
def test_codes(found, n):
    assert found[n] == CASES[n][2]


def test_split_keeps_every_row_once(spark):
    tagged = spark.createDataFrame([(1, ""), (2, "A | B"), (3, "")], "id int, dq_reason string")
    assert {r["id"] for r in quality.accepted(tagged).collect()} == {1, 3}
    assert "dq_reason" not in quality.accepted(tagged).columns
    (bad,) = quality.rejected(tagged).collect()
    assert (bad["id"], bad["dq_reason"]) == (2, "A | B") and bad["quarantine_timestamp"] is not None


def test_volume_counts_both_sides(spark):
    rows = "load_date date, dq_reason string"
    tagged = spark.createDataFrame([(None, ""), (None, "A")], rows)
    (row,) = quality.volume_by_entity({"orders": tagged}).collect()
    assert (row["valid_rows"], row["invalid_rows"], row["total_rows"]) == (1, 1, 2)


def test_columns_of_own_rules_are_not_shuffled(spark):
    """Rules that need no other row are judged before the joins; the codes stay in rule order."""
    rows = [("1", "o", "x", None, "lost"), ("1", "p", "2026-01-01", 5, "success"), (" ", None, "2026-01-01", 5, "failed")]
    raw = spark.createDataFrame(rows, "payment_id string, order_id string, payment_date string, amount_kopecks long, status string")
    parents = spark.createDataFrame([("p", "2026-02-01")], "order_id string, created_at string")
    tagged = tagged_payments(typed(raw, "payments"), parents.withColumn("created_at", F.to_timestamp("created_at")))
    assert sorted(r.dq_reason for r in tagged.collect()) == [
        "PAYMENT_ID_DUPLICATE_IN_LOAD | ORDER_NOT_FOUND | PAYMENT_DATE_INVALID | PAYMENT_AMOUNT_INVALID | PAYMENT_STATUS_INVALID",
        "PAYMENT_ID_DUPLICATE_IN_LOAD | PAYMENT_BEFORE_ORDER",
        "PAYMENT_ID_EMPTY | ORDER_ID_EMPTY | ORDER_NOT_FOUND",
    ]
    plan = tagged.select("dq_reason")._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Join")]
    assert "status" not in above and "amount_kopecks" not in above and "_own_broken" in above


def test_what_a_look_up_decided_does_not_travel_to_the_next(spark):
    """Orders are judged before copies are counted: only the id, the day and the bits are left."""
    raw = spark.createDataFrame(
        [("1", "p", "2026-01-01", 5, "success"), ("1", "q", "2026-03-01", 5, "success"), ("2", "p", "2026-03-01", 5, "success")],
        "payment_id string, order_id string, payment_date string, amount_kopecks long, status string",
    )
    parents = spark.createDataFrame([("p", "2026-02-01")], "order_id string, created_at string")
    tagged = tagged_payments(typed(raw, "payments"), parents.withColumn("created_at", F.to_timestamp("created_at")))
    assert sorted(r.dq_reason for r in tagged.collect()) == [
        "",
        "PAYMENT_ID_DUPLICATE_IN_LOAD | ORDER_NOT_FOUND",
        "PAYMENT_ID_DUPLICATE_IN_LOAD | PAYMENT_BEFORE_ORDER",
    ]
    plan = tagged.select("dq_reason")._jdf.queryExecution().optimizedPlan().toString()
    between = plan[plan.index("Join") : plan.index("Join", plan.index("Join") + 1)]
    assert re.search(r"Project \[payment_id#\d+, \(+_own_broken#\d+ \+ [^,]*\) AS _own_broken#\d+\]", between)


def test_flags_are_those_of_the_rules_one_by_one(spark):
    """Bits gathered before, between and after the look-ups give the codes of the plain conditions."""
    ids = F.when(F.col("id") % 7 == 0, " ").when(F.col("id") % 5 > 0, F.col("id").cast("string")).otherwise("same")
    order = F.when(F.col("id") % 6 > 0, F.concat(F.lit("o"), F.col("id") % 9))
    raw = spark.range(400).select(
        ids.alias("payment_id"),
        order.alias("order_id"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("2026-01-0"), F.col("id") % 9 + 1)).alias("payment_date"),
        (F.col("id") % 13).cast("string").alias("amount_kopecks"),
        F.when(F.col("id") % 4 == 0, "lost").otherwise("success").alias("status"),
    )
    parents = spark.range(6).select(
        F.concat(F.lit("o"), "id").alias("order_id"), F.lit("2026-01-05").cast("timestamp").alias("created_at")
    )
    rows = typed(raw, "payments")
    tagged = tagged_payments(rows, parents)
    rules = quality.payment_rules()
    plain = quality.with_reasons(enriched_payments(rows, parents), rules).select(*tagged.columns)
    assert sorted(map(str, tagged.collect())) == sorted(map(str, plain.collect()))
    for rule in rules:
        assert not tagged.where(F.contains("dq_reason", F.lit(rule.code))).isEmpty(), rule.code
