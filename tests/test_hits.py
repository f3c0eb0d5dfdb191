"""Rule hits and quarantine volumes counted where rules are judged: the same, and no row meets its copies."""

from dayledger.operators import quality
from dayledger.operators.reconcile import reason_hits
from dayledger.plans import day_gate
from dayledger.sources.driver_tables import DriverTables
from test_plans import plan_of
from test_volume import DAYS, listed, payments  # noqa: F401

COLUMNS = ("load_date", "reason", "quarantined_rows")


def same(hits, tagged):
    expected = reason_hits(quality.rejected(tagged))
    assert listed(hits, COLUMNS) == listed(expected, COLUMNS)
    assert hits.dtypes == expected.dtypes


def test_payments(spark, payments):  # noqa: F811
    orders = spark.sql("SELECT 'o1' AS order_id, timestamp'2026-06-01 09:00:00' AS created_at")
    hits = day_gate.payment_hits(payments, orders)
    same(hits, day_gate.tagged_payments(payments, orders))
    copies = hits.where("reason = 'PAYMENT_ID_DUPLICATE_IN_LOAD'").collect()
    assert sorted((str(r.load_date), r.quarantined_rows) for r in copies) == [("2026-06-01", 3), ("2026-06-02", 1)]


def test_missing_keys_are_copies_of_each_other(spark, payments):  # noqa: F811
    orders = spark.sql("SELECT 'o1' AS order_id, timestamp'2026-06-01 09:00:00' AS created_at")
    twice = payments.unionByName(payments.where("payment_id IS NULL"))
    same(day_gate.payment_hits(twice, orders), day_gate.tagged_payments(twice, orders))


def test_customers_with_and_without_history(spark):
    customers = spark.sql(
        f"""SELECT id AS customer_id, CAST(at AS timestamp) AS registration_date, CAST(day AS date) AS load_date
        FROM VALUES ('c1', '2026-06-01'), ('c2', '2026-06-01'), ('c3', NULL), ('', '2026-06-01'), (NULL, NULL) AS t(id, at)
        LATERAL VIEW explode(array({DAYS})) AS day WHERE id <> 'c1' OR day = '2026-06-01'"""
    )
    history = spark.sql("SELECT 'c1' AS customer_id, date'2000-12-01' AS load_date")
    for clean in (None, history):
        hits = day_gate.customer_hits(customers, clean, "2001-01-01")
        same(hits, day_gate.tagged_customers(customers, clean, "2001-01-01"))


def test_nothing_rejected_and_no_rows(spark, payments):  # noqa: F811
    orders = spark.sql("SELECT 'o1' AS order_id, timestamp'2026-06-01 09:00:00' AS created_at")
    for rows in (payments.where("payment_id = 'p1'"), payments.where("false")):
        assert day_gate.payment_hits(rows, orders).collect() == []


def test_whole_tables(spark, sf_dir):
    tables = DriverTables(spark, sf_dir)
    by_rows = tables.marts
    by_rows.tables._builders = {k: v for k, v in by_rows.tables._builders.items() if k.startswith("quarantine_")}
    counted = DriverTables(spark, sf_dir).marts
    for mart in ("dq_reason_breakdown", "quarantine_volume"):
        found, expected = getattr(counted, mart), getattr(by_rows, mart)
        assert found.dtypes == expected.dtypes
        assert listed(found, found.columns) == listed(expected, found.columns) != []


def test_no_row_is_joined_with_its_copies(spark, sf_dir):
    marts = DriverTables(spark, sf_dir).marts
    for mart in (marts.dq_reason_breakdown, marts.quarantine_volume):
        joins = [line for line in plan_of(mart).splitlines() if "Join" in line]
        assert joins and not any("payment_id" in join for join in joins)
