"""A third of all rows under one key: the work must be split and the result stay whole."""

import pytest
from pyspark.sql import functions as F

from dayledger.operators.versions import latest_version
from dayledger.plans import invariants, metrics
from dayledger.plans.day_gate import tagged_orders, tagged_payments
from dayledger.plans.marts import Marts
from dayledger.sources.schemas import ORDER_MOMENTS

ROWS = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(autouse=True)
def small_thresholds(spark):
    before = {name: spark.conf.get(name) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def final_plan(df):
    """Run the plan with every column and return what was executed."""
    everything = F.sum(F.xxhash64(*df.columns) % 1000)
    summed = df.agg(everything, F.count("*").alias("rows"))
    rows = summed.collect()[0]["rows"]
    return summed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0], rows


def joins(plan):
    return [line.strip() for line in plan.splitlines() if "SortMergeJoin" in line]


@pytest.fixture
def base(spark):
    return spark.range(0, ROWS, 1, 8).withColumn("hot", F.col("id") % 3 == 0).withColumn(
        "pad", F.sha2(F.col("id").cast("string"), 512)
    )


@pytest.fixture
def orders(base):
    moment = F.lit("2026-06-01 00:00:00").cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, id % 100000)")
    nothing = {name: F.lit(None).cast("timestamp_ntz") for name in ORDER_MOMENTS[1:]}
    return base.select(
        F.col("id").cast("string").alias("order_id"),
        F.when(F.col("hot"), "hot").otherwise((F.col("id") % 5000).cast("string")).alias("customer_id"),
        moment.alias("created_at"),
        (F.col("id") + 1).alias("amount_kopecks"),
        F.lit("new").alias("status"),
        F.col("pad").alias("cancellation_reason"),
        F.lit("card").alias("payment_method"),
        F.to_date(F.lit("2026-06-01")).alias("load_date"),
    ).withColumns(nothing)


@pytest.fixture
def customers(spark):
    ids = F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string"))
    return spark.range(5000).select(
        ids.alias("customer_id"),
        F.lit("2026-05-01 00:00:00").cast("timestamp_ntz").alias("registration_date"),
        F.concat(F.lit("city"), F.col("id") % 7).alias("city"),
        F.lit("organic").alias("acquisition_channel"),
        F.to_date(F.lit("2026-05-01")).alias("load_date"),
    )


def test_payment_gate_splits_a_copied_id_and_missing_keys(spark, base):
    payments = base.select(
        F.when(F.col("hot"), "same").otherwise(F.col("id").cast("string")).alias("payment_id"),
        F.when(~F.col("hot"), (F.col("id") % 1000).cast("string")).alias("order_id"),
        F.lit("2026-06-01 10:00:00").cast("timestamp").alias("payment_date"),
        (F.col("id") + 1).alias("amount_kopecks"),
        F.col("pad").alias("payment_method"),
        F.lit("success").alias("status"),
    )
    parents = spark.range(1000).select(
        F.col("id").cast("string").alias("order_id"),
        F.lit("2026-06-01 09:00:00").cast("timestamp").alias("created_at"),
    )
    tagged = tagged_payments(payments, parents)
    plan, rows = final_plan(tagged)
    assert rows == ROWS
    assert len(joins(plan)) == 2 and all("skew=true" in join for join in joins(plan))
    counts = {r["dq_reason"]: r["count"] for r in tagged.groupBy("dq_reason").count().collect()}
    assert counts == {
        "": ROWS - ROWS // 3,
        "PAYMENT_ID_DUPLICATE_IN_LOAD | ORDER_ID_EMPTY | ORDER_NOT_FOUND": ROWS // 3,
    }


def test_order_gate_splits_a_busy_customer(orders, customers):
    plan, rows = final_plan(tagged_orders(orders, customers))
    assert rows == ROWS and "skew=true" in joins(plan)[0]


def test_fact_splits_a_busy_customer(orders, customers):
    marts = Marts({"orders": orders, "customers": customers})
    plan, rows = final_plan(marts.orders_with_customer_dim)
    assert rows == ROWS and any("skew=true" in join for join in joins(plan))


def test_payments_of_one_order_are_split(orders, base):
    payments = base.select(
        F.col("id").cast("string").alias("payment_id"),
        F.when(F.col("hot"), "1").otherwise(F.col("id").cast("string")).alias("order_id"),
        F.lit("2026-06-01 00:00:00").cast("timestamp_ntz").alias("payment_date"),
        F.col("id").alias("amount_kopecks"),
        F.col("pad").alias("payment_method"),
        F.lit("success").alias("status"),
        F.to_date(F.lit("2026-06-01")).alias("load_date"),
    )
    check = invariants.payment_not_before_order(Marts({"orders": orders, "payments": payments}))
    # Every order but the first was created after midnight, and that one has no payment.
    early = check.first()
    assert (early["ok"], early["detail"]) == (False, str(ROWS))


def test_turnover_reduces_a_busy_customer_before_the_join(orders, customers):
    marts = Marts({"orders": orders, "customers": customers})
    by_city = marts.orders_summed_by_customer_dims(
        orders, ("city",), {"kopecks": F.col("amount_kopecks"), "n": F.lit(1)}
    )
    totals = by_city.agg(F.sum("kopecks").alias("k"), F.sum("n").alias("n")).first()
    assert (totals["k"], totals["n"]) == (ROWS * (ROWS + 1) // 2, ROWS)


def test_numbering_spreads_a_busy_customer_over_slots(orders, customers):
    marts = Marts({"orders": orders, "customers": customers})
    numbered = marts.orders_with_sequence
    top = numbered.groupBy("customer_id").agg(
        F.max("order_seq").alias("top"), F.count("*").alias("n"), F.count_distinct("order_seq").alias("d")
    )
    assert top.where("top <> n OR d <> n").isEmpty()
    assert top.where("customer_id = 'hot'").first()["n"] == ROWS // 3


def test_versions_of_one_key_shrink_before_the_shuffle(base):
    versions = base.select(
        F.when(F.col("hot"), "hot").otherwise(F.col("id").cast("string")).alias("order_id"),
        F.expr("date_add(date'2026-01-01', CAST(id % 1000 AS INT))").alias("load_date"),
        "id",
    )
    latest = latest_version(versions, ["order_id"], tie_breaks=["id"])
    assert latest.count() == ROWS - ROWS // 3 + 1
    top = latest.where("order_id = 'hot'").first()
    assert top["id"] % 1000 == 999 and top["id"] % 3 == 0


def test_first_order_and_retention_of_a_busy_customer(orders, customers):
    marts = Marts({"orders": orders, "customers": customers})
    hot = marts.customer_first_order.where("customer_id = 'hot'").first()
    assert hot["orders_count"] == ROWS // 3 and hot["days_to_first_order"] == 31
    assert metrics.order_count(marts).first()["orders"] == ROWS
