"""Hand-sized tables with the edges of every definition."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dayledger.plans import invariants, metrics
from dayledger.plans.marts import Marts

CUSTOMER = "customer_id string, registration_date timestamp_ntz, city string, acquisition_channel string, load_date date"
ORDER = (
    "order_id string, customer_id string, created_at timestamp_ntz, amount_kopecks bigint, status string, "
    "cancellation_reason string, payment_method string, paid_at timestamp_ntz, shipped_at timestamp_ntz, "
    "ready_for_pickup_at timestamp_ntz, delivered_at timestamp_ntz, cancelled_at timestamp_ntz, "
    "returned_at timestamp_ntz, refunded_at timestamp_ntz, load_date date"
)
PAYMENT = (
    "payment_id string, order_id string, payment_date timestamp_ntz, amount_kopecks bigint, "
    "payment_method string, status string, load_date date"
)
REJECT = "order_id string, dq_reason string, load_date date"


def at(text):
    return datetime.fromisoformat(text)


def order(order_id, customer_id, created_at, load_date=None, amount=100, status="new", **moments):
    names = ("paid_at", "shipped_at", "ready_for_pickup_at", "delivered_at", "cancelled_at", "returned_at", "refunded_at")
    created = at(created_at)
    return (
        order_id,
        customer_id,
        created,
        amount,
        status,
        moments.pop("reason", None),
        None,
        *(at(moments[n]) if n in moments else None for n in names),
        date.fromisoformat(load_date) if load_date else created.date(),
    )


def customer(customer_id, registered, city="A", channel="organic"):
    moment = at(registered)
    return (customer_id, moment, city, channel, moment.date())


@pytest.fixture
def build(spark):
    def make(customers=(), orders=(), payments=(), rejects=(), **kwargs):
        quarantine = spark.createDataFrame(list(rejects), REJECT)
        empty = quarantine.where("false")
        return Marts(
            {
                "customers": spark.createDataFrame(list(customers), CUSTOMER),
                "orders": spark.createDataFrame(list(orders), ORDER),
                "payments": spark.createDataFrame(list(payments), PAYMENT),
                "quarantine_customers": empty,
                "quarantine_orders": quarantine,
                "quarantine_payments": empty,
            },
            **kwargs,
        )

    return make


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_horizon_is_strict(build):
    marts = build(
        orders=[
            order("last", "c", "2026-09-01T00:00:00"),
            order("edge", "c", "2026-07-29T00:00:00"),  # exactly 34 days before
            order("mature", "c", "2026-07-28T23:59:59"),
            order("settled_edge", "c", "2026-08-30T00:00:00"),  # exactly 2 days before
        ]
    )
    assert rows(marts.orders.where("is_mature"), "order_id") == [("mature",)]
    assert rows(marts.orders.where("is_payment_settled"), "order_id") == [("edge",), ("mature",)]


def test_labels_pass_unknown_codes_through(build):
    marts = build(orders=[order("a", "c", "2026-06-01", status="Delivered"), order("b", "c", "2026-06-01", status="paid")])
    assert rows(marts.orders, "order_id", "status_ru") == [("a", "Delivered"), ("b", "Оплачен")]


def test_fact_keeps_orders_without_customer(build):
    marts = build(customers=[customer("c", "2026-06-01")], orders=[order("a", "c", "2026-06-01"), order("b", "x", "2026-06-01")])
    assert rows(marts.orders_with_customer_dim, "order_id", "city") == [("a", "A"), ("b", "")]


def test_first_order_window(build):
    customers = [customer(c, "2026-06-01T10:00:00") for c in ("at", "end", "before", "both", "none", "sameday", "lastday")]
    orders = [
        order("1", "at", "2026-06-01T10:00:00"),
        order("2", "end", "2026-07-01T10:00:00"),  # registration + 30 days: outside
        order("3", "before", "2026-06-01T09:59:59"),
        order("4", "both", "2026-06-01T09:59:59"),
        order("5", "both", "2026-06-01T10:00:01"),  # both sides of the start on one day
        order("6", "sameday", "2026-06-01T09:00:00"),
        order("7", "sameday", "2026-07-01T11:00:00"),
        order("8", "lastday", "2026-07-01T09:59:59"),
        order("9", "lastday", "2026-07-01T10:00:01"),
        order("10", "far", "2026-12-01T10:00:01"),
    ]
    marts = build(customers=customers, orders=orders)
    out = rows(marts.customer_first_order, "customer_id", "orders_count", "has_order", "converted_within_window", "days_to_first_order")
    assert out == [
        ("at", 1, True, True, 0),
        ("before", 1, True, False, 0),
        ("both", 2, True, True, 0),
        ("end", 1, True, False, 30),
        ("lastday", 2, True, True, 30),
        ("none", 0, False, False, None),
        ("sameday", 2, True, False, 0),
    ]
    assert marts.customer_first_order.where("customer_id = 'none'").first()["first_order_at"] is None


def test_weekly_retention_has_zero_weeks_and_no_negative_offsets(build):
    marts = build(
        customers=[customer("a", "2026-06-03"), customer("b", "2026-06-04"), customer("c", "2026-06-16")],
        orders=[
            order("0", "c", "2026-06-02"),  # two weeks before registration
            order("1", "a", "2026-06-05"),
            order("2", "a", "2026-06-05T12:00:00"),
            order("3", "a", "2026-06-22"),
        ],
    )
    out = rows(marts.customer_cohort_retention, "cohort_week", "weeks_since_signup", "active_customers", "is_mature")
    assert out == [
        ("2026-06-01", 0, 1, True),
        ("2026-06-01", 1, 0, True),
        ("2026-06-01", 2, 0, True),
        ("2026-06-01", 3, 1, False),
        ("2026-06-15", 0, 0, True),
        ("2026-06-15", 1, 0, False),
        ("2026-06-15", 2, 0, False),
        ("2026-06-15", 3, 0, False),
    ]


def test_retention_without_orders_is_empty(build):
    assert build(customers=[customer("a", "2026-06-03")]).customer_cohort_retention.count() == 0


def test_hour_grid_is_dense_and_keeps_every_order(build):
    marts = build(
        customers=[customer("a", "2026-06-01")],
        orders=[order("1", "a", "2026-06-01T10:59:59"), order("2", "x", "2026-06-01T10:00:00"), order("3", "a", "2026-06-08T23:00:00")],
    )
    grid = marts.orders_by_hour_dow
    busy = rows(grid.where("orders > 0"), "dow_label", "hour_of_day", "city", "orders", "days")
    assert busy == [("1 · Пн", 10, "", 1, 2), ("1 · Пн", 10, "A", 1, 2), ("1 · Пн", 23, "A", 1, 2)]
    assert grid.select("dow_label", "hour_of_day").distinct().count() == 168
    assert grid.agg(F.sum("orders")).first()[0] == 3


def test_refund_durations(build):
    marts = build(
        orders=[
            order("cancel", "c", "2026-06-01", cancelled_at="2026-06-02T00:00:00", refunded_at="2026-06-02T01:00:00"),
            order("return", "c", "2026-06-01", returned_at="2026-06-02T00:00:00", refunded_at="2026-06-02T00:00:00"),
            order("negative", "c", "2026-06-01", returned_at="2026-06-02", refunded_at="2026-06-01T23:00:00"),
            order("neither", "c", "2026-06-01", refunded_at="2026-06-02"),
        ]
    )
    out = rows(marts.refund_processing_times, "order_id", "refund_kind", "duration_seconds")
    assert out == [("cancel", "Отмена", 3600), ("return", "Возврат товара", 0)]


def test_fractions_of_seconds_are_cut_first(build):
    marts = build(orders=[order("a", "c", "2026-06-01T00:00:00.900000", paid_at="2026-06-01T00:00:02.100000")])
    assert rows(marts.order_stage_durations, "stage", "duration_seconds") == [("1. Оплата", 2)]


def test_reasons_split_and_volume_does_not(build):
    marts = build(rejects=[("o", "CUSTOMER_NOT_FOUND | ODD_CODE", date(2026, 6, 1)), ("p", "CUSTOMER_NOT_FOUND", date(2026, 6, 1))])
    assert rows(marts.dq_reason_breakdown, "reason", "quarantined_rows") == [("ODD_CODE", 1), ("Покупатель не найден", 2)]
    assert rows(marts.quarantine_volume, "entity", "quarantined_rows") == [("Заказы", 2)]


def test_versions_do_not_double_orders(build):
    marts = build(
        customers=[customer("c", "2026-06-01")],
        orders=[
            order("a", "c", "2026-06-01T10:00:00"),
            order("a", "c", "2026-06-01T10:00:00", load_date="2026-06-03", status="paid", paid_at="2026-06-03"),
        ],
    )
    assert rows(marts.orders, "order_id", "status") == [("a", "paid")]
    assert metrics.version_symptom(marts.tables["orders"]).first()["unresolved"]
    assert invariants.one_row_per_order(marts).first()["ok"]


def test_current_tables_are_not_resolved_again(build):
    doubled = [order("a", "c", "2026-06-01"), order("a", "c", "2026-06-01")]
    assert build(orders=doubled, current=True).orders.count() == 2
    assert not invariants.one_row_per_order(build(orders=doubled, current=True)).first()["ok"]


def test_open_order_needs_a_rejected_row(build):
    orders = [order("open", "c", "2026-06-01", status="paid"), order("last", "c", "2026-09-01")]
    assert not invariants.open_orders_explained(build(orders=orders)).first()["ok"]
    explained = build(orders=orders, rejects=[("open", "ORDER_STATUS_INVALID", date(2026, 6, 2))])
    assert invariants.open_orders_explained(explained).first()["ok"]


def test_ratios_of_nothing_are_null(build):
    marts = build(orders=[order("a", "c", "2026-06-01")])
    assert metrics.average_order_value(marts).first()["aov"] is None
    assert metrics.cancellation_share(marts).first()["cancelled_share"] is None
    assert metrics.conversion(marts).first()["conversion"] is None
    assert metrics.gmv_total(marts).first()["gmv_millions"] == 0


def test_filters_by_period_city_and_channel(build):
    marts = build(
        customers=[customer("a", "2026-01-01", "A", "organic"), customer("b", "2026-01-01", "B", "email")],
        orders=[
            order("1", "a", "2026-06-01T00:00:00"),
            order("2", "a", "2026-06-02T23:59:59"),
            order("3", "a", "2026-06-03T00:00:00"),
            order("4", "b", "2026-06-02T00:00:00"),
        ],
    )

    def count(**kwargs):
        return metrics.order_count(marts, metrics.Filters(**kwargs)).first()["orders"]

    assert count() == 4
    assert count(period=("2026-06-01", "2026-06-02")) == 3
    assert count(cities=["A"]) == 3
    assert count(channels=["Email-рассылка"]) == 1
    assert count(period=("2026-06-02", "2026-06-02"), cities=["A", "B"]) == 2


def test_new_and_repeat_follow_the_sequence(build):
    marts = build(
        orders=[
            order("1", "a", "2026-06-01T10:00:00"),
            order("2", "a", "2026-06-01T10:00:00"),
            order("3", "b", "2026-06-01T11:00:00"),
            order("4", "a", "2026-06-02T11:00:00"),
        ]
    )
    out = rows(metrics.new_and_repeat_orders_by_day(marts), "day", "kind", "orders")
    assert out == [
        (date(2026, 6, 1), "Новый", 2),
        (date(2026, 6, 1), "Повторный", 1),
        (date(2026, 6, 2), "Повторный", 1),
    ]
    assert rows(marts.orders_with_sequence, "order_id", "order_seq") == [("1", 1), ("2", 2), ("3", 1), ("4", 3)]


def test_freshness_counts_clock_hours(build, spark):
    ledger = spark.createDataFrame(
        [("orders", date(2026, 6, 1), at("2026-06-02T00:59:00")), ("orders", date(2026, 5, 1), at("2026-06-01T00:00:00"))],
        "entity string, load_date date, loaded_at timestamp_ntz",
    )
    marts = Marts({"load_commits": ledger}, as_of=F.lit("2026-06-02 01:01:00").cast("timestamp_ntz"))
    assert rows(marts.load_freshness, "entity", "last_load_date", "hours_since_load") == [("orders", date(2026, 6, 1), 1)]
    assert metrics.data_lag(marts).first()["lag_hours"] == 1


def test_enforce_names_what_is_broken(build):
    marts = build(
        customers=[customer("c", "2026-01-01")],
        orders=[order("a", "c", "2026-06-01", status="delivered", paid_at="2026-06-01"), order("z", "c", "2026-09-01")],
        payments=[("p", "a", at("2026-05-01"), 1, "card", "success", date(2026, 6, 1))],
    )
    with pytest.raises(invariants.BrokenInvariant) as error:
        invariants.enforce(marts)
    broken = {part.split(":")[0] for part in str(error.value).split("; ")}
    assert broken == {"conversion_below_one", "net_below_paid", "payment_not_before_order"}
    assert invariants.report(marts).count() == 17


def test_an_order_whose_creation_changed_breaks_uniqueness(build):
    again = build(orders=[order("o", "c", "2026-06-01T00:00:00"), order("o", "c", "2026-06-02T00:00:00", "2026-06-03")])
    once = build(orders=[order("o", "c", "2026-06-01T00:00:00"), order("o", "c", "2026-06-01T00:00:00", "2026-06-03")])
    assert not invariants.one_row_per_order(again).first().ok
    assert invariants.one_row_per_order(once).first().ok


def test_retention_labels_hold_more_than_a_hundred_weeks(build):
    weeks = [datetime(2020, 1, 6) + timedelta(weeks=n) for n in range(116)]
    marts = build(
        customers=[customer("c", "2020-01-06T00:00:00")],
        orders=[order(f"o{n}", "c", w.isoformat()) for n, w in enumerate(weeks) if n != 10],
    )
    cells = {r.week: r.retention for r in metrics.retention(marts).collect()}
    assert len(cells) == 115
    assert cells["нед. 010"] == 0.0 and cells["нед. 100"] == 1.0


def test_period_applies_to_registrations_and_is_refused_without_a_time_column(build):
    marts = build(
        customers=[customer("never", "2025-03-01T00:00:00"), customer("buys", "2026-01-05T00:00:00")],
        orders=[order("o", "buys", "2026-01-06T00:00:00"), order("late", "buys", "2026-09-01T00:00:00")],
    )
    year = metrics.Filters(period=("2025-01-01", "2025-12-31"))
    assert metrics.conversion(marts).first().conversion == 0.5
    assert metrics.conversion(marts, year).first().conversion == 0.0
    for metric in (metrics.hourly_load, metrics.orders_per_customer):
        with pytest.raises(ValueError):
            metric(marts, year)


def test_every_broken_check_is_reported_with_its_meaning(build):
    marts = build(orders=[order("o", "c", "2026-06-01T00:00:00"), order("o", "c", "2026-06-02T00:00:00", "2026-06-03")])

    def cannot_run(m):
        raise KeyError("no such table")

    with pytest.raises(invariants.BrokenInvariant) as raised:
        invariants.enforce(marts, (cannot_run, invariants.one_row_per_order, invariants.join_keeps_orders))
    text = str(raised.value)
    assert "cannot_run: could not run" in text and "one_row_per_order: 2 vs 1 (orders are counted" in text
    assert "join_keeps_orders" not in text
    assert {c.__name__ for c in invariants.CHECKS} == set(invariants.MEANING)
