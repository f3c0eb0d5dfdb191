"""Volumes counted without tagging the rows: the same figures, and no row meets its copies."""

import pytest

from dayledger.operators import quality
from dayledger.plans import day_gate
from dayledger.sources.driver_tables import DriverTables
from test_plans import plan_of

DAYS = "'2026-06-01', '2026-06-02', NULL"


def listed(df, columns):
    return sorted(map(repr, df.select(*columns).collect()))


def same(volume, entity, tagged):
    columns = ("load_date", "valid_rows", "invalid_rows", "total_rows")
    expected = quality.volume_by_entity({entity: tagged}).drop("entity")
    assert listed(volume, columns) == listed(expected, columns)
    assert volume.dtypes == expected.select(*volume.columns).dtypes


@pytest.fixture
def payments(spark):
    # Copies on one day, over two days, a clean and a broken one, ids and orders that are missing.
    return spark.sql(
        """SELECT payment_id, order_id, CAST(payment_date AS timestamp) AS payment_date, CAST(amount AS bigint) AS
        amount_kopecks, 'card' AS payment_method, status, CAST(day AS date) AS load_date FROM VALUES
        ('p1', 'o1', '2026-06-01 10:00:00', 5, 'success', '2026-06-01'),
        ('p2', 'o1', '2026-06-01 08:00:00', 5, 'success', '2026-06-01'),
        ('p3', 'o1', '2026-06-01 10:00:00', 5, 'success', '2026-06-01'),
        ('p3', 'o1', '2026-06-01 10:00:00', 0, 'success', '2026-06-01'),
        ('p4', 'o1', '2026-06-01 10:00:00', 5, 'success', '2026-06-01'),
        ('p4', 'o1', '2026-06-02 10:00:00', 5, 'success', '2026-06-02'),
        ('p5', 'o9', '2026-06-02 10:00:00', 5, 'success', '2026-06-02'),
        ('p6', NULL, '2026-06-02 10:00:00', 5, 'success', '2026-06-02'),
        (NULL, 'o1', '2026-06-02 10:00:00', 5, 'success', '2026-06-02'),
        (' ', 'o1', '2026-06-02 10:00:00', 5, 'success', '2026-06-02'),
        ('p7', 'o1', NULL, 5, 'success', '2026-06-02'),
        ('p8', 'o1', '2026-06-02 10:00:00', 5, 'success', NULL),
        ('p9', 'o1', '2026-06-02 10:00:00', 5, 'lost', NULL)
        AS t(payment_id, order_id, payment_date, amount, status, day)"""
    )


def test_payments(spark, payments):
    orders = spark.sql("SELECT 'o1' AS order_id, timestamp'2026-06-01 09:00:00' AS created_at")
    volume = day_gate.payment_volume(payments, orders)
    same(volume, "payments", day_gate.tagged_payments(payments, orders))
    assert sorted((r.valid_rows, r.total_rows) for r in volume.collect()) == [(0, 6), (1, 2), (1, 5)]


def test_customers_with_and_without_history(spark):
    customers = spark.sql(
        f"""SELECT id AS customer_id, CAST(at AS timestamp) AS registration_date, CAST(day AS date) AS load_date
        FROM VALUES ('c1', '2026-06-01'), ('c2', '2026-06-01'), ('c2', '2026-06-01'), ('c3', NULL), ('', '2026-06-01'),
        (NULL, '2026-06-01') AS t(id, at) LATERAL VIEW explode(array({DAYS})) AS day WHERE id <> 'c1' OR day IS NULL
        OR day = '2026-06-01' AND at IS NULL"""
    )
    history = spark.sql("SELECT 'c1' AS customer_id, date'2000-12-01' AS load_date")
    for clean in (None, history):
        volume = day_gate.customer_volume(customers, clean, "2001-01-01")
        same(volume, "customers", day_gate.tagged_customers(customers, clean, "2001-01-01"))


def test_whole_tables(spark, sf_dir):
    tables = DriverTables(spark, sf_dir)
    columns = ("load_date", "entity", "valid_rows", "invalid_rows", "total_rows")
    tagged = {entity: tables.tagged(entity) for entity in ("customers", "orders", "payments")}
    assert listed(tables.dq_metrics, columns) == listed(quality.volume_by_entity(tagged), columns)


def test_no_row_is_joined_with_its_copies(spark, sf_dir):
    joins = [line for line in plan_of(DriverTables(spark, sf_dir).dq_metrics).splitlines() if "Join" in line]
    assert joins and not any("payment_id" in join for join in joins)
