from datetime import date, datetime

from dayledger.operators import lookups
from dayledger.plans.day_gate import GateOptions, enriched_customers, tagged_orders, typed

CUSTOMER = "customer_id string, registration_date timestamp"


def test_parents_may_be_bounded_by_a_lookback(spark):
    days = [date(2026, 1, n) for n in (1, 20, 31)]
    parents = spark.createDataFrame([(str(d.day), d) for d in days], "id string, load_date date")
    kept = GateOptions(parent_lookback_days=15).parents(parents, "2026-02-01")
    assert {r.id for r in kept.collect()} == {"20", "31"}
    assert GateOptions().parents(parents, "2026-02-01") is parents


def test_null_ids_are_copies_of_each_other(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4), ("b", 5)], "id string, n int")
    counted = {r["n"]: r["copies_in_load"] for r in lookups.with_copies_in_load(df, "id").collect()}
    assert counted == {1: 2, 2: 2, 3: 1, 4: 2, 5: 2}


def test_copies_with_different_payload_are_all_kept(spark):
    df = spark.createDataFrame([("x", i) for i in range(500)] + [("y", -1)], "id string, n int")
    out = lookups.with_copies_in_load(df, "id").collect()
    assert len(out) == 501
    assert {r["copies_in_load"] for r in out if r["id"] == "x"} == {500}


def test_history_window_borders(spark):
    clean = spark.createDataFrame(
        [
            ("inside", date(2025, 6, 1)),  # 365 days before
            ("outside", date(2025, 5, 31)),  # 366 days before
            ("today", date(2026, 6, 1)),
            ("later", date(2026, 6, 2)),
        ],
        "customer_id string, load_date date",
    )
    rows = [(name, None) for name in ("inside", "outside", "today", "later", "new")]
    customers = spark.createDataFrame(rows, CUSTOMER)

    def known(options):
        out = enriched_customers(customers, clean, "2026-06-01", options).collect()
        return {r["customer_id"] for r in out if r["in_history"]}

    assert known(GateOptions()) == {"inside"}
    assert known(GateOptions(strictly_before=False)) == {"inside", "later"}
    assert known(GateOptions(lookback_days=366)) == {"inside", "outside"}


def test_first_day_has_no_history(spark):
    customers = spark.createDataFrame([("a", None)], CUSTOMER)
    assert enriched_customers(customers, None, "2026-06-01").first()["in_history"] is None


def test_parent_moment_and_missing_parent(spark):
    rows = spark.createDataFrame([("p1", "o1"), ("p2", "o2"), ("p3", None)], "payment_id string, order_id string")
    parents = spark.createDataFrame(
        [("o1", datetime(2026, 6, 1)), ("o1", datetime(2026, 6, 1)), (None, datetime(2026, 6, 1))],
        "order_id string, created_at timestamp",
    )
    out = lookups.with_parent_moment(rows, parents, "order_id", "created_at", "order_known", "order_created_at")
    found = {r["payment_id"]: (r["order_known"], r["order_created_at"]) for r in out.collect()}
    assert found == {"p1": (True, datetime(2026, 6, 1)), "p2": (None, None), "p3": (None, None)}


def test_order_without_customer_earns_both_codes(spark):
    text = "order_id string, customer_id string, created_at string, amount_kopecks bigint, status string, "
    text += "cancellation_reason string, paid_at string, shipped_at string, ready_for_pickup_at string, "
    text += "delivered_at string, cancelled_at string, returned_at string, refunded_at string"
    raw = spark.createDataFrame(
        [("o1", None, "2026-06-01 10:00:00", 5, "new", *[None] * 8), ("o2", "c1", "rubbish", 5, "new", *[None] * 8)],
        text,
    )
    parents = spark.createDataFrame([("c1",)], "customer_id string")
    tagged = tagged_orders(typed(raw, "orders"), parents)
    assert {r["order_id"]: r["dq_reason"] for r in tagged.collect()} == {
        "o1": "CUSTOMER_ID_EMPTY | CUSTOMER_NOT_FOUND",
        "o2": "CREATED_AT_INVALID",
    }
