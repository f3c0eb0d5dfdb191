from datetime import date, datetime

from dayledger.operators import versions
from dayledger.operators.lifecycle import overdue_orders
from dayledger.horizons import Deadlines, Horizons

ROW = "order_id string, status string, paid_at timestamp, load_date date"
D = [date(2026, 6, n) for n in range(1, 10)]


def test_newest_load_date_wins_whatever_the_order_of_loading(spark):
    rows = [("a", "paid", None, D[2]), ("a", "new", None, D[1]), ("b", "new", None, D[1]), ("a", "new", None, D[0])]
    for order in (rows, rows[::-1]):
        out = versions.latest_version(spark.createDataFrame(order, ROW), ["order_id"])
        assert {r["order_id"]: r["status"] for r in out.collect()} == {"a": "paid", "b": "new"}


def test_ties_are_settled_by_tie_breaks(spark):
    df = spark.createDataFrame([("a", "x", None, D[1]), ("a", "z", None, D[1]), ("a", "y", None, D[1])], ROW)
    assert versions.latest_version(df, ["order_id"], tie_breaks=["status"]).first()["status"] == "z"
    assert versions.first_version(df, ["order_id"], tie_breaks=["status"]).first()["status"] == "x"


def test_open_orders(spark):
    paid = datetime(2026, 6, 1)
    rows = [
        ("new", "new", None, D[4]),
        ("closed", "refunded", paid, D[4]),
        ("closed", "cancelled", paid, D[3]),
        ("waiting", "cancelled", paid, D[4]),
        ("unpaid", "cancelled", None, D[4]),
        ("delivered", "delivered", paid, D[4]),
        ("old", "new", None, D[0]),
        ("future", "new", None, D[6]),
    ]
    out = versions.open_orders(spark.createDataFrame(rows, ROW), "2026-06-05", 3)
    assert {r["order_id"] for r in out.collect()} == {"new", "waiting", "delivered"}


def test_known_customers(spark):
    rows = [
        ("a", datetime(2026, 6, 1), "first", D[0]),
        ("a", datetime(2026, 6, 1), "second", D[1]),
        ("edge", datetime(2026, 6, 3), "first", D[1]),
        ("late", datetime(2026, 6, 3, 0, 0, 1), "first", D[1]),
    ]
    df = spark.createDataFrame(rows, "customer_id string, registration_date timestamp, city string, load_date date")
    out = {r["customer_id"]: r["city"] for r in versions.known_customers(df, "2026-06-02").collect()}
    assert out == {"a": "first", "edge": "first"}


def test_overdue_orders(spark):
    rows = [
        ("unpaid", "new", datetime(2026, 6, 1, 10), None),
        ("fresh", "new", datetime(2026, 6, 1, 10, 0, 1), None),
        ("waiting", "ready_for_pickup", datetime(2026, 5, 1), datetime(2026, 5, 26, 10)),
        ("recent", "ready_for_pickup", datetime(2026, 5, 1), datetime(2026, 5, 26, 10, 1)),
        ("done", "delivered", datetime(2026, 5, 1), datetime(2026, 5, 2)),
    ]
    schema = "order_id string, status string, created_at timestamp_ntz, ready_for_pickup_at timestamp_ntz"
    out = overdue_orders(spark.createDataFrame(rows, schema), "2026-06-02 10:00:00").collect()
    assert {r["order_id"]: r["overdue_reason"] for r in out} == {
        "unpaid": "not_paid_in_time",
        "waiting": "not_picked_up_in_time",
    }


def test_horizons():
    assert (Horizons().maturity_days, Horizons().payment_settlement_days) == (34, 2)
    assert Horizons(Deadlines(payment_hours=25, refund_hours=1)).maturity_days == 2 + 2 + 7 + 7 + 14 + 1
