"""Physical plans: what is read, shuffled and joined."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from fixtures import tables
from tripmetrics.operators import filters, records, zips
from tripmetrics.operators import trips as tr
from tripmetrics.sources import load_stage, save_stage

WRITES_OR_FITS = {"cluster_centers", "centre_check"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stage") / "trips")
    save_stage(records.normalize_trips(tables.trips_raw(spark, sf_dir)), path, partition_by="year")
    return load_stage(spark, path)


@pytest.mark.parametrize("name", sorted(set(spark_entry._QUERIES) - WRITES_OR_FITS))
def test_no_pairwise_joins_and_no_python(spark, sf_dir, name):
    plan = plan_of(spark_entry.queries()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "ArrowEval", "ExistingRDD"):
        assert bad not in plan, plan


def test_grouping_shuffles_once(staged):
    for df in (tr.hourly_means(staged), tr.trips_by_year(staged), tr.taxi_revenue_per_trip(staged)):
        plan = plan_of(df)
        assert plan.count("Exchange") == 1
        assert "partial_" in plan


def test_only_needed_columns_are_read(staged):
    scan = next(line for line in plan_of(tr.hourly_means(staged)).splitlines() if "FileScan" in line)
    read = scan[scan.index("ReadSchema") :]
    assert read == "ReadSchema: struct<fare:double,tips:double,speed_mph:double,midpoint_hour:int>"


def test_text_times_are_parsed_once_per_row(spark, sf_dir):
    """No filter below the aggregate repeats the parsing that the grouping key needs."""
    trips = records.normalize_trips(tables.trips_raw(spark, sf_dir))
    plan = plan_of(tr.trips_by_year(trips))
    assert plan.count("try_to_timestamp") == 1


@pytest.mark.parametrize("name", ["trips_with_rain_hourly", "time_money_corr", "rain_money_corr"])
@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_the_key_of_the_rain_join_is_parsed_once(spark, sf_dir, name, limit):
    """Of trips only: rain is a stage by then. No filter below the join tests the key for NULL."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        plan = plan_of(spark_entry.queries()[name](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("try_to_timestamp") == 1, plan


def test_the_summary_of_quality_parses_no_time(spark, sf_dir):
    assert "try_to_timestamp" not in plan_of(spark_entry.queries()["quality_summary"](spark, sf_dir))


def test_epoch_seconds_of_text_parse_once(spark, sf_dir):
    assert plan_of(spark_entry.queries()["trip_unix_time"](spark, sf_dir)).count("try_to_timestamp") == 1


def test_a_year_of_text_times_is_parsed_once_in_the_filter(spark, sf_dir):
    trips = records.normalize_trips(tables.trips_raw(spark, sf_dir))
    plan = plan_of(filters.year_slice(trips, 2025, staged=False).select("trip_id"))
    condition = next(line for line in plan.splitlines() if "Filter (" in line)
    assert condition.count("try_to_timestamp") == 1


def test_top_lists_do_not_sort_everything(staged):
    for df in (
        tr.top_taxis_per_trip(staged),
        tr.top_tips_per_mile(staged),
        tr.trips_chronological(staged, 10),
    ):
        plan = plan_of(df)
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_small_stages_are_broadcast_and_large_ones_are_not(spark, sf_dir):
    query = spark_entry.queries()["time_money_corr"]
    assert "BroadcastHashJoin" in plan_of(query(spark, sf_dir))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(query(spark, sf_dir))
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_nearest_zips_without_broadcast_gives_the_same(spark, sf_dir):
    query = spark_entry.queries()["zip_pairs"]
    expected = sorted(tuple(r) for r in query(spark, sf_dir).collect())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = query(spark, sf_dir)
        assert "SortMergeJoin" in plan_of(shuffled)
        assert sorted(tuple(r) for r in shuffled.collect()) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize(("limit", "cut"), [("10m", "row_number(), 5, Final"), ("-1", "row_number(), 5, Partial")])
def test_each_task_passes_on_few_candidates(spark, sf_dir, limit, cut):
    """Candidates stay where their position is while leaves are broadcast, and are cut before a shuffle otherwise."""
    points = zips.trip_ends(tables.trip_points(spark, sf_dir))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        plan = plan_of(zips.nearest_zips(points, tables.zip_reference(spark, sf_dir)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert cut in plan


def test_hot_positions_become_one_row(spark):
    trips = spark.range(100000).select(
        F.col("id").alias("trip_id"),
        *[F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id") / 1000).alias(c) for c in records.POSITION_COLUMNS],
    )
    ends = zips.trip_ends(trips)
    assert plan_of(ends).count("HashAggregate") == 2
    assert ends.count() == trips.select("start_lat").distinct().count()
