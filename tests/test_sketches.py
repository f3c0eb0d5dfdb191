from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from dayledger.operators import sketches
from dayledger.plans import metrics
from dayledger.sources import sketches as stored

SHARES = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


@pytest.fixture(scope="module")
def values(spark):
    """A third of the rows in one group, a group without a name, ties, values missing."""
    n = F.col("id")
    return spark.range(90_000).select(
        F.date_add(F.lit("2026-06-01").cast("date"), (n % 10).cast("int")).alias("load_date"),
        F.when(n % 3 == 0, "hot").when(n % 3 == 1, (n % 4).cast("string")).alias("kind"),
        F.when(n % 50 != 7, F.pmod(F.hash("id"), F.lit(1000)) * F.pmod(F.hash("id"), F.lit(7))).alias("seconds"),
    )


@pytest.fixture(scope="module")
def root(values, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sketches"))
    stored.store_days(values, path, "durations", "load_date", "kind", "seconds")
    return path


def errors_of(spark, root, values, period=None):
    found = stored.read_sketches(spark, root, "durations", period)
    estimates = sketches.merged_percentiles(found, "kind", SHARES)
    if period is not None:
        values = sketches.of_days(values, "load_date", *period)
    totals = {r.kind: r.values_total for r in estimates.collect()}
    exact = {r.kind: r.n for r in values.groupBy("kind").agg(F.count("seconds").alias("n")).collect()}
    assert totals == exact and None in totals and "hot" in totals
    errors = sketches.rank_errors(values, estimates, "kind", "seconds", SHARES).collect()
    assert {r.kind for r in errors} == set(totals)
    return [r[name] for r in errors for name in SHARES]


@pytest.mark.parametrize("period", [None, ("2026-06-03", "2026-06-05"), ("2026-06-10", "2026-07-10")])
def test_rank_errors_keep_the_bound_for_any_period(spark, root, values, period):
    assert max(errors_of(spark, root, values, period)) <= sketches.RANK_ERROR


def test_the_check_sees_a_wrong_answer(spark, root, values):
    wrong = sketches.merged_percentiles(stored.read_sketches(spark, root, "durations"), "kind", {"p50": 0.53})
    errors = sketches.rank_errors(values, wrong, "kind", "seconds", {"p50": 0.5}).collect()
    assert all(r.p50 > sketches.RANK_ERROR for r in errors)


def test_a_period_reads_only_its_days(spark, root):
    period = stored.read_sketches(spark, root, "durations", ("2026-06-03", "2026-06-04"))
    plan = period._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan
    assert len(period.inputFiles()) and period.select("load_date").distinct().count() == 2


def test_values_are_sketched_before_the_shuffle(values):
    sketched = sketches.day_sketches(values, "load_date", "kind", "seconds")
    plan = sketched._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange") :]
    assert plan.count("Exchange") == 1 and "partial_kll_sketch_agg_bigint" in before


def test_a_day_is_replaced_and_may_become_empty(spark, values, tmp_path):
    path, first = str(tmp_path), date(2026, 6, 1)
    for n in range(2):
        day = values.where(F.col("load_date") == F.lit(first + timedelta(n)))
        stored.store_day(day, path, "d", str(first + timedelta(n)), "kind", "seconds")
    both = sum(r.values_total for r in sketches.merged_percentiles(stored.read_sketches(spark, path, "d"), "kind", SHARES).collect())
    stored.store_day(values.limit(0), path, "d", "2026-06-02", "kind", "seconds")
    one = sum(r.values_total for r in sketches.merged_percentiles(stored.read_sketches(spark, path, "d"), "kind", SHARES).collect())
    held = values.where("load_date = '2026-06-01'").agg(F.count("seconds")).first()[0]
    assert one == held < both


def test_empty_tables_and_single_values(spark, values):
    nothing = sketches.day_sketches(values.limit(0), "load_date", "kind", "seconds")
    assert sketches.merged_percentiles(nothing, "kind", SHARES).collect() == []
    one = spark.createDataFrame([(date(2026, 6, 1), "a", 7200)], "load_date date, refund_kind string, s long")
    got = metrics.refund_hours_sketched(sketches.day_sketches(one, "load_date", "refund_kind", "s")).collect()
    assert [tuple(r) for r in got] == [("a", 1, 2.0, 2.0, 2.0)]


def test_missing_sketches_are_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        stored.read_sketches(spark, str(tmp_path), "none")
