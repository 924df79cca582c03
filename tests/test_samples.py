"""Samples by content: the same rows from any layout, with the chances they state."""

from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tripmetrics.operators import filters


def digest(seed, *values):
    text = str(seed) + "".join("-" if v is None else f"={v}" for v in values)
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def poisson(u, mean):
    """Copies of a row whose digest is ``u``: how far its share reaches into the distribution."""
    copies, below = 0, math.exp(-mean)
    while u >= math.floor(below * 2**32) and copies < 200:
        copies += 1
        below += math.exp(-mean) * mean**copies / math.factorial(copies)
    return copies


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(20_000).select(F.col("id").alias("trip_id"), (F.col("id") % 7).alias("taxi_id"))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("fraction", [0.0, 0.01, 0.5, 1.0])
def test_sample_is_what_the_digests_say(numbers, fraction):
    got = rows(filters.sample_trips(numbers, fraction))
    assert got == [(i, i % 7) for i in range(20_000) if digest(81, i) < math.floor(fraction * 2**32)]
    assert abs(len(got) - 20_000 * fraction) <= 4 * math.sqrt(20_000 * fraction * (1 - fraction))


@pytest.mark.parametrize("parts", [1, 7, 16])
def test_rows_do_not_follow_the_layout(spark, numbers, tmp_path, parts):
    numbers.repartition(parts, "taxi_id").write.parquet(str(tmp_path / "trips"))
    again = spark.read.parquet(str(tmp_path / "trips"))
    assert rows(filters.sample_trips(again, 0.1)) == rows(filters.sample_trips(numbers, 0.1))
    assert rows(filters.bootstrap_points(again, 0.7)) == rows(filters.bootstrap_points(numbers, 0.7))


@pytest.mark.parametrize("mean", [0.0, 0.1, 1.0, 3.5, 20.0, 100.0])
def test_bootstrap_follows_the_poisson_distribution(spark, mean):
    n = 20_000 if mean < 10 else 500
    got = rows(filters.bootstrap_points(spark.range(n).withColumnRenamed("id", "trip_id"), mean))
    assert got == [(i,) for i in range(n) for _ in range(poisson(digest(81, i), mean))]
    assert abs(len(got) - n * mean) <= 5 * math.sqrt(n * mean)


def test_seeds_keys_and_missing_values(spark):
    data = [(1, "a"), (1, "b"), (None, "a"), (None, None), (2, "")] * 40
    df = spark.createDataFrame(data, "trip_id long, taxi_id string")
    for key in (("trip_id",), ("trip_id", "taxi_id")):
        want = [r for r in data if digest(5, *r[: len(key)]) < 2**31]
        got = filters.sample_trips(df, 0.5, seed=5, key=key).collect()
        assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert filters.sample_trips(df.limit(0), 0.5).count() == filters.bootstrap_points(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        filters.bootstrap_points(df, 101)


def test_a_bootstrap_is_a_map(numbers):
    plan = filters.bootstrap_points(numbers)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("md5") == 1
