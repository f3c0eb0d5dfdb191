"""The shape of the plans: what is read, what is shuffled, what is never done."""

import re

import pytest
from pyspark.sql import functions as F

from dayledger.catalog import QUERIES
from dayledger.operators import lookups
from dayledger.operators.versions import latest_version, within_lookback
from dayledger.plans import metrics
from dayledger.plans.marts import Marts
from dayledger.sources.driver_tables import DriverTables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, sf_dir):
    return DriverTables(spark, sf_dir)


def test_latest_version_drops_old_versions_before_the_shuffle(tables):
    plan = plan_of(latest_version(tables.payments, ["payment_id"]))
    # Read bottom up: a partial limit, one exchange, a final limit.
    steps = re.findall(r"WindowGroupLimit .*(Partial|Final)|(Exchange) hashpartitioning", plan)
    assert [a or b for a, b in steps] == ["Final", "Exchange", "Partial"]


def test_unused_milestones_and_dimensions_are_not_read(tables):
    plan = plan_of(metrics.order_count(tables.marts))
    assert "l_orderkey" not in plan and "c_custkey" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_funnel_scans_orders_once_besides_the_horizon(tables):
    plan = plan_of(tables.marts.order_funnel_stages)
    main = plan.split("Subqueries")[0]
    assert main.count("l_shipdate") > 0
    assert len(re.findall(r"FileScan parquet \[l_orderkey", main)) == 1


def test_breakdown_joins_customers_after_adding_up_orders(tables):
    plan = plan_of(metrics.gmv_by_city_top10(tables.marts))
    join = plan.index("LeftOuter")
    assert "partial_sum" in plan[join:], "orders must be summed per customer below the join"
    assert "TakeOrderedAndProject" in plan


def test_lookback_prunes_partitions(spark, tables, tmp_path):
    by_year = tables.payments.withColumn("load_date", F.trunc("load_date", "year"))
    by_year.write.partitionBy("load_date").parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    for pruned in (
        within_lookback(stored, "1999-06-01", 365),
        lookups.earlier_keys(stored, "payment_id", "1999-06-01", 365),
        lookups.earlier_keys(stored, "payment_id", "1999-06-01", 365, strictly_before=False),
    ):
        plan = plan_of(pruned)
        filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
        assert "load_date" in filters
    keys = plan_of(lookups.earlier_keys(stored, "payment_id", "1999-06-01", 365))
    assert "ReadSchema: struct<payment_id:string>" in keys


def test_period_filter_reaches_the_scan_of_stored_versions(spark, tables, tmp_path):
    tables.order_versions.write.parquet(str(tmp_path / "orders"))
    marts = Marts({"orders": spark.read.parquet(str(tmp_path / "orders"))})
    period = metrics.Filters(period=("1997-01-01", "1997-12-31"))
    plan = plan_of(metrics.statuses_by_day(marts, period))
    # Long lists are cut in the plan's text.
    assert "PushedFilters: [IsNotNull(created_at), GreaterThanOrEqual(" in plan
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*order_id", plan)) == 1
    # The horizon is the maximum of one column, without resolving versions.
    assert "ReadSchema: struct<created_at:timestamp_ntz>" in plan


def test_parents_are_reduced_to_the_keys_of_the_day(tables):
    plan = plan_of(tables.enriched("payments"))
    semi = plan.index("LeftSemi")
    assert "partial_min" in plan[:semi], "the grouping stands above the semi join"


# One of every group whose plan joins, numbers or explodes rows.
@pytest.mark.parametrize(
    "name",
    [
        "d22_gate_customers",
        "d22_gate_orders",
        "d22_gate_payments",
        "m06_orders_by_hour_dow",
        "m07_customer_first_order",
        "m10_customer_cohort_retention",
        "m15_orders_with_sequence",
        "q26_stage_hours",
        "q39_city_share_finding",
        "v13_payment_not_before_order",
        "v16_open_orders_explained",
        "r06_reconcile",
    ],
)
def test_no_cross_joins_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "InPandas"):
        assert banned not in plan


def test_no_hints_force_a_broadcast(tables):
    # Sides are broadcast by measured size only, never by a hint.
    for df in (tables.marts.orders_with_customer_dim, tables.tagged("payments"), tables.clock_marts.orders_by_hour_dow):
        assert "broadcast" not in df._jdf.queryExecution().logical().toString().lower()


def test_membership_reads_and_joins_orders_once(spark, sf_dir):
    """Both answers come from one join: twice as many rows in one stage would halve its tasks."""
    found = QUERIES["j11_membership"](spark, sf_dir)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Union" not in plan
    rows = [(r.order_id, r.touched) for r in found.collect()]
    refunded = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_returnflag NOT IN ('N', 'A')")
    wanted = {r.l_orderkey for r in refunded.select("l_orderkey").distinct().collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    assert {key for key, there in rows if there} == wanted & {key for key, _ in rows}
