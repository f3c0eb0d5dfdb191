"""The filter of a load's keys at the scan of the history."""

import re

import pytest
from pyspark.sql import functions as F

from dayledger.operators import lookups
from dayledger.operators.key_filter import BUCKET, key_filter, may_be_in
from test_skew import final_plan


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("bits", [BUCKET, 1 << 18])
def test_every_key_passes_and_few_others(spark, kind, bits):
    keys = spark.range(0, 6000, 3).select(F.col("id").cast(kind).alias("key"))
    rows = spark.range(-20_000, 20_000).select(F.col("id").cast(kind).alias("key"), "id")
    passed = {r.id for r in rows.where(may_be_in(key_filter(keys, "key", bits), "key", bits)).collect()}
    wanted = set(range(0, 6000, 3))
    assert wanted <= passed
    assert len(passed - wanted) < (12 if bits > BUCKET else 2_000)


def test_null_keys_and_empty_loads(spark):
    rows = spark.createDataFrame([("a",), (None,), ("b",)], "key string")
    some = spark.createDataFrame([("a",), (None,), ("a",)], "key string")
    assert [r.key for r in rows.where(may_be_in(key_filter(some, "key"), "key")).collect()] == ["a"]
    assert rows.where(may_be_in(key_filter(some.where("false"), "key"), "key")).isEmpty()
    assert rows.where(may_be_in(key_filter(some.where("key IS NULL"), "key"), "key")).isEmpty()


def test_only_wanted_parents_are_shuffled(spark):
    """Without any broadcast: of 300000 parents little more than the day's 1000 reach a shuffle."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parents = spark.range(300_000).select(
            F.col("id").cast("string").alias("order_id"), F.timestamp_seconds("id").alias("created_at")
        )
        day = spark.range(1000).select((F.col("id") * 299).cast("string").alias("order_id"), "id")
        found = lookups.with_parent_moment(day, parents, "order_id", "created_at", "known", "at")
        passed = lookups.of_keys_in(parents, day, "order_id").count()
        assert 1000 <= passed <= 1020
        plan, rows = final_plan(found)
        assert rows == 1000 and found.where("known AND at = timestamp_seconds(id * 299)").count() == 1000
        assert "Broadcast" not in plan and len(re.findall("SortMergeJoin", plan)) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_without_parents_are_told_apart(spark):
    parents = spark.createDataFrame([("p1", 5), ("p1", 3), ("p2", 9), (None, 1)], "key string, moment int")
    rows = spark.createDataFrame([("p1",), ("p3",), (None,)], "key string")
    got = lookups.with_parent_moment(rows, parents, "key", "moment", "known", "at").collect()
    assert sorted(map(tuple, got), key=str) == [("p1", 3, True), ("p3", None, None), (None, None, None)]


def test_filter_is_hashed_and_left_out_for_very_many_keys(spark):
    """Nothing is sorted for it; of too many different keys there is none, and all rows pass."""
    rows = spark.range(20_000).select(F.col("id").alias("key"))
    few = rows.select((F.col("key") % 4000).alias("key"))
    for keys, there in ((few, True), (rows, False)):
        row = spark.range(1).select(key_filter(keys, "key", BUCKET).isNotNull().alias("there"))
        assert row.first().there is there
        assert "SortAggregate" not in row._jdf.queryExecution().executedPlan().toString()
    others = spark.range(-9_000, 0).select(F.col("id").alias("key"))
    assert others.where(may_be_in(key_filter(rows, "key", BUCKET), "key", BUCKET)).count() == 9_000
    assert others.where(may_be_in(key_filter(few, "key", BUCKET), "key", BUCKET)).count() < 4_000
