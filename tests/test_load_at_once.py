"""Writes of a day that do not wait for each other."""

from threading import Barrier

import pytest

from dayledger.plans import day_gate
from dayledger.session import side_by_side
from dayledger.sources import layers, ledger
from test_loading import DAY1, two_days  # noqa: F401


def test_tables_of_a_load_are_written_at_once(spark, two_days, monkeypatch):  # noqa: F811
    day_gate.gate_day(spark, two_days, DAY1)
    everyone = Barrier(len(ledger.DATA_TABLES), timeout=60)
    order = []

    def write(rows, warehouse, table, load_date):
        if table != ledger.LEDGER:
            everyone.wait()
        layers.write_day(rows, warehouse, table, load_date)
        order.append(table)

    monkeypatch.setattr(ledger, "write_day", write)
    assert ledger.load_day(spark, two_days, f"{two_days}/warehouse", DAY1)
    assert sorted(order[:-1]) == sorted(ledger.DATA_TABLES) and order[-1] == ledger.LEDGER
    marker = ledger.read_ledger(spark, f"{two_days}/warehouse")
    assert {r["entity"]: r["rows"] for r in marker.collect()} == {
        table: layers.read_day(spark, f"{two_days}/warehouse", table, DAY1).count() for table in ledger.DATA_TABLES
    }


def test_a_table_that_fails_leaves_the_day_open(spark, two_days, monkeypatch):  # noqa: F811
    day_gate.gate_day(spark, two_days, DAY1)

    def write(rows, warehouse, table, load_date):
        if table == "orders":
            raise OSError("lost")
        layers.write_day(rows, warehouse, table, load_date)

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "write_day", write)
        with pytest.raises(OSError, match="lost"):
            ledger.load_day(spark, two_days, f"{two_days}/warehouse", DAY1)
    assert not ledger.is_committed(spark, f"{two_days}/warehouse", DAY1)
    assert ledger.load_day(spark, two_days, f"{two_days}/warehouse", DAY1)


def test_all_jobs_end_before_an_error_is_raised(spark):
    done = []

    def fail():
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        side_by_side(spark, [fail, lambda: done.append(1), lambda: done.append(2)])
    assert sorted(done) == [1, 2] and side_by_side(spark, []) == []
