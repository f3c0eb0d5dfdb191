"""Published states of the tables of latest versions: crashes, readers, months, removal.

Days are written as load_day writes them; `commits` stands for the ledger's markers.
"""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from dayledger.sources import current, layers

DAYS = ["2026-06-01", "2026-06-02", "2026-06-03"]
SCHEMAS = {
    "orders": "order_id string, customer_id string, created_at timestamp_ntz, amount_kopecks bigint, status string",
    "payments": "payment_id string, order_id string, payment_date timestamp_ntz, amount_kopecks bigint, "
    "payment_method string, status string",
}


class Crash(Exception):
    pass


class Warehouse:
    def __init__(self, spark, path, entity, monkeypatch):
        monkeypatch.setattr(current, "KEYS", {entity: current.KEYS[entity]})
        self.spark, self.path, self.entity, self.commits, self.number = spark, str(path), entity, {}, 0

    def load(self, day, rows):
        """The marker goes first and is written last; the day's rows are replaced in between."""
        self.commits.pop(date.fromisoformat(day), None)
        df = rows if hasattr(rows, "write") else self.spark.createDataFrame(rows, SCHEMAS[self.entity]).coalesce(1)
        layers.write_day(df, self.path, self.entity, day)
        self.number += 1
        current.publish(self.spark, self.path, day, f"commit{self.number}", self.commits)
        self.commits[date.fromisoformat(day)] = f"commit{self.number}"

    def seen(self):
        tables = current.current_tables(self.spark, self.path, self.commits)
        return None if tables is None else tables[self.entity]

    def check(self):
        """What a reader of the current table sees is what the history resolves to."""
        history = current._history(self.spark, self.path, self.entity, self.commits)
        resolved = current._latest(history, self.entity)
        assert rows_of(self.seen(), resolved.columns) == rows_of(resolved, resolved.columns)


def rows_of(df, columns):
    return sorted(map(repr, df.select(columns).collect()))


def moment(days):
    return datetime(2026, 1, 15) + timedelta(days=days)


def order(n, status, created=0):
    return (f"o{n}", f"c{n % 3}", moment(created), 100 + n, status)


def crashing(monkeypatch, where, after):
    """Writers that fail before or right after the first write to such a path."""
    write = DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        if where not in path:
            return write(self, path, *args, **kwargs)
        if after:
            write(self, path, *args, **kwargs)
        raise Crash

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)


def test_a_crash_at_any_write_leaves_the_state_before(spark, tmp_path, monkeypatch):
    w = Warehouse(spark, tmp_path, "orders", monkeypatch)
    w.load(DAYS[0], [order(1, "new"), order(2, "new", 40)])
    w.load(DAYS[1], [order(1, "paid"), order(3, "new", 80)])
    before = rows_of(w.seen(), ["order_id", "status"])
    # After one write is before the next: the rows, the delta, the new base, the manifest.
    for where, after in (("/orders/load_date", True), ("/delta", True), ("/base", True), ("_states", False), ("_states", True)):
        with monkeypatch.context() as patch:
            crashing(patch, where, after)
            if (where, after) == ("_states", True):
                with pytest.raises(Crash):
                    w.load(DAYS[2], [order(3, "paid", 80)])
            else:
                with pytest.raises(Crash):
                    w.load(DAYS[2], [order(3, "wrong", 80), order(4, "wrong")])
        assert rows_of(w.seen(), ["order_id", "status"]) == before
    w.load(DAYS[2], [order(3, "paid", 80)])  # builds on what the last attempt left unmarked
    w.check()
    assert [r.status for r in w.seen().orderBy("order_id").collect()] == ["paid", "new", "paid"]


def test_a_reload_without_its_rows_brings_older_versions_back(spark, tmp_path, monkeypatch):
    w = Warehouse(spark, tmp_path, "orders", monkeypatch)
    w.load(DAYS[0], [order(1, "new"), order(2, "new")])
    w.load(DAYS[1], [order(1, "paid"), order(3, "new")])
    with monkeypatch.context() as patch:
        crashing(patch, "_states", after=False)
        with pytest.raises(Crash):
            w.load(DAYS[1], [])
    w.check()  # the day is open, and the state before it is whole again
    w.load(DAYS[1], [order(2, "paid")])
    w.check()
    assert rows_of(w.seen(), ["order_id", "status"]) == [
        "Row(order_id='o1', status='new')",
        "Row(order_id='o2', status='paid')",
    ]
    w.commits[date.fromisoformat(DAYS[0])] = "loaded without a state"
    assert w.seen() is None
    w.load(DAYS[2], [order(9, "new")])  # built from the history
    w.check()


@pytest.mark.parametrize("most_deltas, share", [(8, 100.0), (1, 0.5)])
def test_days_in_any_order_and_keys_that_move_between_months(spark, tmp_path, monkeypatch, most_deltas, share):
    """Payments whose date changes belong to another month from then on, and may come back."""
    monkeypatch.setattr(current, "MOST_DELTAS", most_deltas)
    monkeypatch.setattr(current, "DELTA_SHARE", share)
    w = Warehouse(spark, tmp_path, "payments", monkeypatch)
    rng = random.Random(most_deltas)
    for n, day in enumerate([DAYS[1], DAYS[0], DAYS[2], DAYS[1]]):
        rows = [
            (f"p{k}", "o1", None if k == 7 else moment(rng.choice([0, 40, 80])), n, "card", "success")
            for k in rng.sample(range(12), 7)
        ]
        w.load(day, rows)
        w.check()
    assert bool(current._states(spark, w.path)[0].deltas) == (most_deltas > 1)


def test_a_day_touches_the_months_of_its_keys(spark, tmp_path, monkeypatch):
    """A thousand keys of two months among two years: two deltas, no base written or shuffled."""
    w = Warehouse(spark, tmp_path, "orders", monkeypatch)
    first = datetime(2024, 1, 1)

    def orders(ids, status):
        created = F.lit(first).cast("timestamp_ntz") + F.expr("make_dt_interval(id % 720)")
        return ids.select(
            F.concat(F.lit("o"), "id").alias("order_id"), F.lit("c").alias("customer_id"),
            created.alias("created_at"), F.col("id").alias("amount_kopecks"), F.lit(status).alias("status"),
        )

    w.load(DAYS[0], orders(spark.range(72_000), "new"))
    (before,) = current._states(spark, w.path)
    assert len(before.bases) == 24 and not before.deltas
    late = spark.range(72_000).where("id % 720 >= 680 AND id % 4 = 0").orderBy("id").limit(1000)
    w.load(DAYS[1], orders(late, "paid"))
    after = current._states(spark, w.path)[0]
    written = [p.parent.name for p in (tmp_path / "_current/orders" / after.name).rglob("*.parquet")]
    assert after.bases == before.bases and len(after.deltas) == 2
    assert set(written) == {f"month={month}" for _, month in after.deltas}
    counts = {r.status: r["count"] for r in w.seen().groupBy("status").count().collect()}
    assert counts == {"new": 71_000, "paid": 1_000}
    plan = w.seen()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # the deltas' keys come to the bases


def test_readers_keep_their_state_until_it_is_removed(spark, tmp_path, monkeypatch):
    w = Warehouse(spark, tmp_path, "orders", monkeypatch)
    w.load(DAYS[0], [order(1, "new"), order(2, "new", 40)])
    opened = w.seen()
    wanted = rows_of(opened, ["order_id", "status"])
    for status in ("paid", "shipped"):
        w.load(DAYS[1], [order(1, status)])
    assert rows_of(opened, ["order_id", "status"]) == wanted
    gone = current.vacuum(spark, w.path, w.commits, keep=1)
    assert [path for path in gone if "_states" in path] == [f"{current.STATES}/state=commit{n}" for n in (1, 2)]
    w.check()
    assert current.vacuum(spark, w.path, w.commits, keep=1) == []
    w.load(DAYS[1], [order(1, "delivered")])
    w.check()


def test_a_day_with_most_rows_goes_to_new_bases_at_once(spark, tmp_path, monkeypatch):
    """No deltas are written and merged for it, also when it is older or loaded again."""
    monkeypatch.setattr(current, "SMALL_LOAD", 0)
    warehouse = Warehouse(spark, tmp_path, "orders", monkeypatch)
    warehouse.load(DAYS[1], [order(n, "paid", 20 * n) for n in range(8)])
    warehouse.load(DAYS[0], [order(n, "new", 20 * n) for n in range(4, 12)])
    warehouse.load(DAYS[1], [order(n, "shipped", 20 * n) for n in range(2, 9)])
    warehouse.check()
    assert all(not state.deltas for state in current._states(spark, str(tmp_path)))
    warehouse.load(DAYS[2], [order(1, "late", 20)])
    warehouse.check()
    newest = current._states(spark, str(tmp_path))[0]
    assert {folder for folder, _ in newest.bases.values()} == {"commit3", "commit4"}, "other months are left alone"
