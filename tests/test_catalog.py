"""The registered queries: complete, comparable and equal to DuckDB's answer."""

import re

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from dayledger import fixed_values
from dayledger.catalog import ORACLES, QUERIES
from dayledger.functions.buckets import stable_bucket

# A sample over the groups; tests/compare.py runs all of them.
SAMPLED = (
    "s06_read_layer",
    "a08_exact_percentiles",
    "a08_sketched_percentiles",
    "m02_orders",
    "m05_orders_with_customer_dim",
    "m07_customer_first_order_few_orders",
    "m10_customer_cohort_retention",
    "m15_orders_with_sequence",
    "q13_refund_hours",
    "q13_refund_hours_sketched",
    "q28_retention",
    "q31_new_and_repeat_orders_by_day",
    "q36_filtered_gmv_by_city",
    "v12_funnel_never_grows",
    "r01_open_orders",
    "r05_stable_bucket",
)


def test_every_inventory_row_is_registered():
    rows = {"s": 17, "p": 13, "d": 22, "j": 11, "a": 14, "w": 5, "t": 4, "u": 3, "e": 4}
    rows |= {"m": 17, "q": 42, "v": 17, "f": 23, "r": 6}
    present = {name[:3] for name in queries()}
    missing = {f"{g}{n:02d}" for g, count in rows.items() for n in range(1, count + 1)} - present
    assert not missing


def test_every_query_has_comparison_sql():
    assert set(QUERIES) == set(ORACLES)
    assert all(re.fullmatch(r"[a-z]\d\d_[a-z0-9_]+", name) for name in QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry_returns_rows(spark):
    assert entry(spark).count() == 10


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", SAMPLED)
def test_equals_duckdb(spark, con, sf_dir, name):
    assert difference(spark, con, name, sf_dir) is None


def test_labels_are_the_agreed_ones():
    """Both sides of the comparison take labels from one place, so a wrong one shows only here."""
    assert fixed_values.ORDER_STATUS_LABELS["cancelled"] == "Отменён"
    assert fixed_values.CHANNEL_LABELS["referral"] == "Рекомендации"
    assert fixed_values.CANCELLATION_LABELS["not_paid_in_time"] == "Не оплачен вовремя"
    assert fixed_values.WEEK_OFFSET_PREFIX == "нед. "
    assert set(fixed_values.ORDER_STATUSES) == set(fixed_values.ORDER_STATUS_LABELS)


def test_buckets_have_two_slices():
    with pytest.raises(ValueError):
        stable_bucket("id", slice_no=2)
