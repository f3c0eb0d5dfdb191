"""Day partitions, the gate over three days and the ledger, in temporary folders."""

from datetime import date

import pytest

from dayledger.__main__ import arguments, run
from dayledger.plans import invariants, metrics
from dayledger.plans.day_gate import gate_day
from dayledger.sources import layers, ledger
from dayledger.sources.schemas import ENTITY_COLUMNS
from dayledger.sources.warehouse import warehouse_marts

DAY1, DAY2 = "2026-06-01", "2026-06-02"


def write_csv(root, entity, day, lines):
    folder = root / "source" / entity / f"load_date={day}"
    folder.mkdir(parents=True)
    text = "\n".join([",".join(ENTITY_COLUMNS[entity]), *lines]) + "\n"
    (folder / f"{entity}.csv").write_text(text, encoding="utf-8")


@pytest.fixture
def two_days(spark, tmp_path):
    write_csv(tmp_path, "customers", DAY1, ["c1,2026-06-01 10:00:00,Омск,organic,a@x", "c2,oops,Омск,email,b@x"])
    write_csv(
        tmp_path,
        "orders",
        DAY1,
        ["o1,c1,2026-06-01 11:00:00,100,new" + "," * 9, "o2,c2,2026-06-01 11:00:00,100,new" + "," * 9],
    )
    write_csv(
        tmp_path,
        "payments",
        DAY1,
        ["p1,o1,2026-06-01 11:00:00,100,card,success", "p2,o2,2026-06-01 12:00:00,100,card,success"],
    )
    # The next day re-issues the order; the customer id appearing again is a defect.
    write_csv(tmp_path, "customers", DAY2, ["c1,2026-06-01 10:00:00,Омск,organic,a@x", "c3,2026-06-02 10:00:00,Уфа,,c@x"])
    write_csv(tmp_path, "orders", DAY2, ["o1,c1,2026-06-01 11:00:00,100,paid,,card,2026-06-02 01:00:00" + "," * 6])
    write_csv(tmp_path, "payments", DAY2, ["p3,o1,2026-06-01 10:59:59,,cash,failed"])
    root = str(tmp_path)
    for day in (DAY1, DAY2):
        layers.ingest_day(spark, root, day)
    return root


def reasons(spark, root, entity, day, key):
    rejected = layers.read_day(spark, f"{root}/quarantine", entity, day).collect()
    return {r[key]: r["dq_reason"] for r in rejected}


def test_rejections_cascade_and_history_is_seen(spark, two_days):
    assert gate_day(spark, two_days, DAY1) == {"customers": (1, 1), "orders": (1, 1), "payments": (1, 1)}
    assert reasons(spark, two_days, "customers", DAY1, "customer_id") == {"c2": "REGISTRATION_DATE_INVALID"}
    assert reasons(spark, two_days, "orders", DAY1, "order_id") == {"o2": "CUSTOMER_NOT_FOUND"}
    assert reasons(spark, two_days, "payments", DAY1, "payment_id") == {"p2": "ORDER_NOT_FOUND"}
    assert gate_day(spark, two_days, DAY2) == {"customers": (1, 1), "orders": (1, 0), "payments": (0, 1)}
    assert reasons(spark, two_days, "customers", DAY2, "customer_id") == {"c1": "CUSTOMER_ID_DUPLICATE_IN_HISTORY"}
    assert reasons(spark, two_days, "payments", DAY2, "payment_id") == {"p3": "PAYMENT_AMOUNT_INVALID | PAYMENT_BEFORE_ORDER"}
    metrics = {r["entity"]: r for r in layers.read_day(spark, two_days, "dq_metrics", DAY2).collect()}
    assert (metrics["orders"]["valid_rows"], metrics["payments"]["invalid_rows"]) == (1, 1)


def test_a_rerun_replaces_only_its_own_day(spark, two_days):
    for day in (DAY1, DAY2, DAY1, DAY2):
        gate_day(spark, two_days, day)
    clean = layers.read_layer(spark, f"{two_days}/clean", "orders").collect()
    assert sorted((r["order_id"], r["status"], r["load_date"]) for r in clean) == [
        ("o1", "new", date(2026, 6, 1)),
        ("o1", "paid", date(2026, 6, 2)),
    ]
    # An empty result must clear what an earlier run left behind.
    layers.write_day(layers.read_day(spark, f"{two_days}/clean", "orders", DAY1).where("false"), f"{two_days}/clean", "orders", DAY1)
    assert layers.read_day(spark, f"{two_days}/clean", "orders", DAY1).count() == 0
    assert layers.read_layer(spark, f"{two_days}/clean", "orders").count() == 1


def test_all_empty_column_keeps_its_type(spark, two_days):
    schema = dict(layers.read_day(spark, f"{two_days}/raw", "orders", DAY1).dtypes)
    assert schema["refunded_at"] == "string" and schema["amount_kopecks"] == "bigint"


def test_raw_is_written_once_and_manifest_counts_it(spark, two_days):
    with pytest.raises(FileExistsError):
        layers.ingest_day(spark, two_days, DAY1)
    manifest = spark.read.json(f"{two_days}/raw/_manifests/load_date={DAY1}").collect()
    assert {r["entity"]: r["rows"] for r in manifest} == {"customers": 2, "orders": 2, "payments": 2}


def test_empty_source_and_missing_day_are_errors(spark, tmp_path):
    write_csv(tmp_path, "payments", DAY1, [])
    path = f"{tmp_path}/source/payments/load_date={DAY1}/payments.csv"
    with pytest.raises(ValueError):
        layers.read_source_csv(spark, path, "payments")
    with pytest.raises(FileNotFoundError):
        layers.read_day(spark, str(tmp_path), "orders", DAY1)
    assert layers.read_layer(spark, str(tmp_path), "orders") is None


def test_load_is_idempotent_and_forced_reload_does_not_double(spark, two_days):
    warehouse = f"{two_days}/warehouse"
    gate_day(spark, two_days, DAY1)
    gate_day(spark, two_days, DAY2)
    assert ledger.load_day(spark, two_days, warehouse, DAY2)
    assert ledger.load_day(spark, two_days, warehouse, DAY1)
    assert not ledger.load_day(spark, two_days, warehouse, DAY1)
    assert ledger.load_day(spark, two_days, warehouse, DAY1, force=True)
    assert layers.read_layer(spark, warehouse, "quarantine_orders").count() == 1
    listing = ledger.ledger_listing(ledger.read_ledger(spark, warehouse)).collect()
    assert len(listing) == 14 and listing[0]["load_date"] == date(2026, 6, 1)
    assert {r["entity"] for r in listing} == set(ledger.DATA_TABLES)


def test_crash_before_the_marker_leaves_the_day_open(spark, two_days, monkeypatch):
    warehouse = f"{two_days}/warehouse"
    gate_day(spark, two_days, DAY1)

    def crash(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "record_commit", crash)
        with pytest.raises(RuntimeError):
            ledger.load_day(spark, two_days, warehouse, DAY1)
    assert not ledger.is_committed(spark, warehouse, DAY1)
    quarantined = layers.read_layer(spark, warehouse, "quarantine_orders")
    assert ledger.committed_only(quarantined, ledger.read_ledger(spark, warehouse)).count() == 0
    # The next attempt starts from a clean day.
    assert ledger.load_day(spark, two_days, warehouse, DAY1)
    assert layers.read_layer(spark, warehouse, "quarantine_orders").count() == 1


def test_marker_goes_first_when_a_day_is_cleared(spark, two_days, monkeypatch):
    order = []
    monkeypatch.setattr(ledger, "clear_day", lambda s, w, table, d: order.append(table))
    ledger.clear_load(spark, two_days, DAY1)
    assert order == [ledger.LEDGER, *ledger.DATA_TABLES]


def test_source_manifests_become_expected_counts(spark, tmp_path):
    folder = tmp_path / f"load_date={DAY1}"
    folder.mkdir()
    (folder / "commit.json").write_text(
        '{\n "load_date": "2026-06-01",\n "expected_quality_issues": {"orders.invalid_status": 3}\n}'
    )
    (row,) = layers.read_source_manifests(spark, f"{tmp_path}/*/commit.json").collect()
    assert (row["load_date"], row["issue_type"], row["expected_rows"]) == (date(2026, 6, 1), "orders.invalid_status", 3)


def test_marts_over_the_loaded_warehouse(spark, two_days):
    for day in (DAY1, DAY2):
        for step in ("gate", "load"):
            run(spark, arguments([step, "--data-dir", two_days, "--load-date", day]))
    marts = warehouse_marts(spark, f"{two_days}/warehouse")
    (order,) = marts.orders_with_customer_dim.collect()
    assert (order["order_id"], order["status_ru"], order["city"]) == ("o1", "Оплачен", "Омск")
    assert {r["entity"]: r["quarantined_rows"] for r in marts.quarantine_volume.where("load_date = '2026-06-01'").collect()} == {
        "Покупатели": 1,
        "Заказы": 1,
        "Платежи": 1,
    }
    assert metrics.rejected_share(marts.tables["dq_metrics"]).first()["rejected_share"] == 0.5
    verdicts = {r["check_name"]: r["ok"] for r in invariants.report(marts).collect()}
    assert len(verdicts) == 17
    # No order is mature yet, so only the two strict comparisons fail.
    assert {name for name, ok in verdicts.items() if not ok} == {"conversion_below_one", "net_below_paid"}
    views = marts.create_views()
    assert spark.table("mart_orders").count() == 1 and len(views) == 17
    within_june = metrics.Filters(period=("2026-06-01", "2026-06-01"), cities=["Омск"])
    assert metrics.order_count(marts, within_june).first()["orders"] == 1


def test_an_open_day_stays_invisible(spark, two_days):
    warehouse = f"{two_days}/warehouse"
    for day in (DAY1, DAY2):
        gate_day(spark, two_days, day)
        ledger.load_day(spark, two_days, warehouse, day)
    layers.clear_day(spark, warehouse, ledger.LEDGER, DAY2)
    assert warehouse_marts(spark, warehouse).orders.first()["status"] == "new"


def test_quotes_commas_and_line_breaks_in_values(spark, tmp_path):
    write_csv(tmp_path, "customers", DAY1, ['c1,2026-06-01 10:00:00,"a ""b"", c",organic,"x@y\nz"', "c2,2026-06-01 10:00:00,Омск,email,b@x"])
    path = f"{tmp_path}/source/customers/load_date={DAY1}/customers.csv"
    got = layers.read_source_csv(spark, path, "customers").orderBy("customer_id").collect()
    assert [(r.customer_id, r.city, r.acquisition_channel, r.email) for r in got] == [
        ("c1", 'a "b", c', "organic", "x@y\nz"),
        ("c2", "Омск", "email", "b@x"),
    ]


def test_a_missing_source_file_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nothing.csv"):
        layers.read_source_csv(spark, f"{tmp_path}/nothing.csv", "customers")


def _same_as_history(spark, warehouse):
    maintained = warehouse_marts(spark, warehouse, current=True)
    assert maintained.current
    resolved = warehouse_marts(spark, warehouse)
    for entity in ("customers", "orders", "payments"):
        columns = resolved.tables[entity].columns
        left, right = (getattr(m, entity).select(columns).collect() for m in (maintained, resolved))
        assert sorted(map(repr, left)) == sorted(map(repr, right)), entity


def test_current_tables_equal_the_resolved_history(spark, two_days, monkeypatch):
    warehouse = f"{two_days}/warehouse"
    for day in (DAY1, DAY2):
        gate_day(spark, two_days, day)
    # An old day after a newer one, a re-run, and a forced reload.
    assert ledger.load_day(spark, two_days, warehouse, DAY2, keep_current=True)
    _same_as_history(spark, warehouse)
    assert ledger.load_day(spark, two_days, warehouse, DAY1, keep_current=True)
    _same_as_history(spark, warehouse)
    assert not ledger.load_day(spark, two_days, warehouse, DAY1, keep_current=True)
    assert ledger.load_day(spark, two_days, warehouse, DAY2, force=True, keep_current=True)
    _same_as_history(spark, warehouse)
    # The day comes again without some of its rows: they are gone, or older versions return.
    clean = layers.read_day(spark, f"{two_days}/clean", "orders", DAY2).collect()
    assert clean
    layers.clear_day(spark, f"{two_days}/clean", "orders", DAY2)
    layers.clear_day(spark, f"{two_days}/clean", "customers", DAY2)
    assert ledger.load_day(spark, two_days, warehouse, DAY2, force=True, keep_current=True)
    _same_as_history(spark, warehouse)


def test_stale_current_tables_are_not_used_and_are_built_anew(spark, two_days, monkeypatch):
    warehouse = f"{two_days}/warehouse"
    for day in (DAY1, DAY2):
        gate_day(spark, two_days, day)
    assert ledger.load_day(spark, two_days, warehouse, DAY1, keep_current=True)
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "record_commit", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ledger.load_day(spark, two_days, warehouse, DAY2, keep_current=True)
    _same_as_history(spark, warehouse)  # the state before the crash is still there and still right
    assert ledger.load_day(spark, two_days, warehouse, DAY2, keep_current=True)
    _same_as_history(spark, warehouse)
    assert ledger.load_day(spark, two_days, warehouse, DAY1, force=True)  # without merging
    assert not warehouse_marts(spark, warehouse, current=True).current
    assert ledger.load_day(spark, two_days, warehouse, DAY1, force=True, keep_current=True)
    _same_as_history(spark, warehouse)
