import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayledger.functions.buckets import stable_bucket
from dayledger.operators.ranking import exact_percentiles, sequence_number
from dayledger.operators.series import calendar, day_type, trailing_mean


def test_sequence_matches_brute_force_with_a_hot_key(spark):
    rng = random.Random(7)
    start = datetime(2026, 6, 1)
    rows = []
    for n in range(3000):
        # One customer holds a third of the rows, some rows have no customer at all.
        customer = "hot" if n % 3 == 0 else rng.choice(["a", "b", "c", None])
        moment = start + timedelta(minutes=rng.randrange(0, 5000, 20))
        rows.append((f"o{n:05d}", customer, moment))
    df = spark.createDataFrame(rows, "order_id string, customer_id string, created_at timestamp_ntz")
    out = sequence_number(
        df, "customer_id", F.date_trunc("hour", "created_at"), ["created_at", "order_id"], "order_seq"
    )
    expected, seen = {}, Counter()
    for order, customer, moment in sorted(rows, key=lambda r: (r[2], r[0])):
        seen[customer] += 1
        expected[order] = seen[customer]
    assert {r["order_id"]: r["order_seq"] for r in out.collect()} == expected


@pytest.mark.parametrize("width", [1, 60, 3600, 10**6])
def test_percentiles_match_numpy(spark, width):
    rng = random.Random(3)
    groups = defaultdict(list)
    for n in range(4000):
        group = "hot" if n % 3 == 0 else rng.choice("ab")
        groups[group].append(rng.choice([0, 60, 3600, rng.randrange(500_000)]))
    groups["one"] = [42]
    groups["two"] = [10, 20]
    rows = [(g, v) for g, values in groups.items() for v in values] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    out = exact_percentiles(df, "g", "v", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, width)
    for row in out.collect():
        expected = np.percentile(groups[row["g"]], [50, 90, 99])
        assert [row["p50"], row["p90"], row["p99"]] == pytest.approx(list(expected))
    assert out.count() == len(groups)


def test_trailing_mean_starts_short(spark):
    df = spark.createDataFrame([(date(2026, 6, d), d) for d in range(1, 10)], "day date, n bigint")
    out = {r["day"].day: r["n_mean7"] for r in trailing_mean(df, "day", ["n"]).collect()}
    assert (out[1], out[2], out[7], out[9]) == (1.0, 1.5, 4.0, 6.0)


def test_calendar_has_days_without_rows(spark):
    df = spark.createDataFrame([(datetime(2026, 6, 1, 23),), (datetime(2026, 6, 4, 1),)], "t timestamp_ntz")
    assert [r["day"].day for r in calendar(df, "t").orderBy("day").collect()] == [1, 2, 3, 4]


def test_day_types(spark):
    cases = {
        date(2026, 11, 11): "promo",
        date(2026, 11, 27): "promo",  # last Friday of November
        date(2026, 11, 20): "payday",
        date(2026, 1, 1): "holiday",
        date(2026, 1, 5): "holiday",  # a holiday beats a payday
        date(2026, 3, 9): "holiday",  # 8 March 2026 is a Sunday
        date(2026, 5, 11): "holiday",  # 9 May 2026 is a Saturday
        date(2026, 5, 12): "normal",
        date(2026, 6, 20): "payday",
    }
    df = spark.createDataFrame([(d,) for d in cases], "d date")
    assert {r["d"]: r["k"] for r in df.select("d", day_type("d").alias("k")).collect()} == cases


def test_bucket_equals_the_hash_slice(spark):
    import hashlib

    ids = [f"cust_{n}" for n in range(50)]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    for slice_no in (0, 1):
        out = {r["id"]: r["b"] for r in df.select("id", stable_bucket("id", slice_no).alias("b")).collect()}
        for i in ids:
            digits = hashlib.md5(i.encode()).hexdigest()[12 * slice_no : 12 * slice_no + 12]
            assert out[i] == int(digits, 16) % 10_000_000 / 10_000_000
