"""Filters, counts, revenue, hours and tips on small tables with known answers, and properties on test data."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import tables
from tripmetrics.operators import filters, records
from tripmetrics.operators import trips as tr
from tripmetrics.operators.peaks import peak_rows

RAW = "trip_id long, taxi_id string, start_text string, end_text string, trip_seconds int, trip_miles double, fare double, tips double"


def raw_trip(trip_id, taxi="a", start="04/13/2017 07:30:00 AM", end="04/13/2017 07:40:00 AM", s=600, m=2.0, f=10.0, t=1.0):
    return (trip_id, taxi, start, end, s, m, f, t)


def trips_of(spark, *rows):
    return records.normalize_trips(spark.createDataFrame(list(rows), RAW))


@pytest.fixture(scope="module")
def fixture_trips(spark, sf_dir):
    return records.normalize_trips(tables.trips_raw(spark, sf_dir)).cache()


def test_quality_limits_are_good_when_met_exactly(spark):
    trips = trips_of(
        spark,
        raw_trip(1, s=60, m=1.0),
        raw_trip(2, s=59, m=1.0),
        raw_trip(3, s=3600, m=100.0),
        raw_trip(4, s=3600, m=100.1),
        raw_trip(5, s=36000, m=1000.0),
        raw_trip(6, s=360000, m=1000.5),
        raw_trip(7, f=2000.0),
        raw_trip(8, f=2000.01),
        raw_trip(9, s=None),
        raw_trip(10, m=None, f=None, t=None),
    )
    assert sorted(r.trip_id for r in filters.good_trips(trips).collect()) == [1, 3, 5, 7, 10]
    assert tr.quality_summary(trips).first().asDict() == {"trips": 10, "good": 5, "bad": 5, "bad_pct": 50.0}
    strict = filters.QualityRules(max_fare=9.0)
    assert [r.trip_id for r in filters.good_trips(trips, strict).collect()] == [10]


def test_quality_of_nothing(spark):
    summary = tr.quality_summary(trips_of(spark, raw_trip(1)).limit(0)).first()
    assert summary.asDict() == {"trips": 0, "good": 0, "bad": 0, "bad_pct": 0.0}


def test_unreadable_times_leave_time_groups_only(spark):
    trips = trips_of(spark, raw_trip(1), raw_trip(2, start="soon"), raw_trip(3, end=None), raw_trip(4, start=None))
    assert tr.trip_count(trips).first().trips == 4
    assert [tuple(r) for r in tr.trips_by_year(trips).collect()] == [(2017, 2)]
    assert [r.midpoint_hour for r in tr.hourly_means(trips).collect()] == [7]
    assert [r.month for r in tr.monthly_tip_means(records.tip_records(trips)).collect()] == [4]
    assert tr.taxi_revenue_per_day(trips).first().days == 1
    ordered = [r.trip_id for r in tr.trips_chronological(trips).collect()]
    assert ordered[:2] == [1, 3] and sorted(ordered[2:]) == [2, 4]


def test_year_slice_edges(spark):
    trips = trips_of(
        spark,
        raw_trip(1, start="12/31/2017 11:59:59 PM"),
        raw_trip(2, start="01/01/2018 12:00:00 AM"),
        raw_trip(3, start="12/31/2018 11:59:59 PM"),
        raw_trip(4, start="01/01/2019 12:00:00 AM"),
        raw_trip(5, start=None),
    )
    assert sorted(r.trip_id for r in filters.year_slice(trips, 2018).collect()) == [2, 3]


def test_revenue(spark):
    trips = trips_of(
        spark,
        raw_trip(1, "a", f=10.0, t=2.0),
        raw_trip(2, "a", f=20.0, t=None),
        raw_trip(3, "a", start="04/14/2017 07:30:00 AM", f=4.0, t=0.0),
        raw_trip(4, "b", f=18.0, t=0.0),
        raw_trip(5, "c", f=17.0, t=1.0),
    )
    per_trip = {r.taxi_id: r.revenue_per_trip for r in tr.taxi_revenue_per_trip(trips).collect()}
    assert per_trip == pytest.approx({"a": 12.0, "b": 18.0, "c": 18.0})
    per_day = {r.taxi_id: (r.days, r.revenue_per_day) for r in tr.taxi_revenue_per_day(trips).collect()}
    assert per_day == {"a": (2, 18.0), "b": (1, 18.0), "c": (1, 18.0)}
    assert [r.taxi_id for r in tr.top_taxis_per_trip(trips, 2).collect()] == ["b", "c"]
    assert tr.top_taxi_total(trips).first().asDict() == {"taxi_id": "a", "revenue": 36.0}
    assert sorted(r.trip_id for r in filters.taxi_slice(trips, "a").collect()) == [1, 2, 3]


def test_one_taxis_mean_against_plain_python(fixture_trips):
    for taxi in (0, 7, 12):
        rows = filters.taxi_slice(fixture_trips, taxi).select("fare", "tips").collect()
        got = tr.taxi_revenue_per_trip(fixture_trips).filter(F.col("taxi_id") == taxi).first()
        if rows:
            assert got.revenue_per_trip == pytest.approx(sum(r.fare + r.tips for r in rows) / len(rows))
        else:
            assert got is None


def test_good_and_bad_add_up(fixture_trips):
    summary = tr.quality_summary(fixture_trips).first()
    assert summary.good == filters.good_trips(fixture_trips).count()
    assert summary.bad == summary.trips - summary.good > 0


def test_years_add_up(fixture_trips):
    assert sum(r.trips for r in tr.trips_by_year(fixture_trips).collect()) == fixture_trips.count()


def test_peaks_are_the_maxima(fixture_trips):
    means = tr.hourly_means(fixture_trips)
    maxima = tr.metric_maxima(means).first().asDict()
    peaks = {r.metric: r for r in tr.hourly_peaks(means).collect()}
    assert {m: peaks[m][m] for m in tr.HOURLY_METRICS} == maxima
    by_hour = {r.midpoint_hour: r for r in means.collect()}
    for peak in peaks.values():
        assert tuple(by_hour[peak.midpoint_hour]) == tuple(peak)[1:]
    totals = tr.hourly_totals(fixture_trips)
    best = {r.metric: r.midpoint_hour for r in tr.hourly_total_peaks(totals).collect()}
    rows = totals.collect()
    assert best == {m: max(rows, key=lambda r: r[m]).midpoint_hour for m in ("fare", "tips")}


def test_peak_ties_go_to_the_smallest_key(spark):
    rows = [(3, 5.0, -1.0), (1, 5.0, -2.0), (2, None, -1.0), (0, 4.0, None)]
    df = spark.createDataFrame(rows, "key int, a double, b double").repartition(4)
    got = {r.metric: r.key for r in peak_rows(df, "key", ("a", "b")).collect()}
    assert got == {"a": 1, "b": 2}
    assert peak_rows(df.limit(0), "key", ("a", "b")).count() == 0


def test_tips(spark):
    trips = trips_of(
        spark,
        raw_trip(1, m=2.0, f=10.0, t=1.0),
        raw_trip(2, m=0.0, f=0.0, t=3.0),
        raw_trip(3, m=1.0, f=30.0, t=3.0),
        raw_trip(4, start="05/01/2016 07:30:00 AM", m=1.0, f=10.0, t=None),
    )
    tips = records.tip_records(trips)
    assert [r.trip_id for r in tr.top_tips_per_mile(trips, 3).collect()] == [2, 3, 1]
    assert tr.overall_tip_pct(trips).first().tip_pct == pytest.approx(14.0)
    assert tr.overall_tip_pct(trips.limit(0)).first().tip_pct == 0.0
    months = {r.month_name: (r.month, r.fare, r.tip_pct) for r in tr.monthly_tip_means(tips).collect()}
    assert months["April"] == pytest.approx((4, 40 / 3, 20 / 3))
    assert months["May"] == (5, 10.0, 0.0)
    assert [r.trip_id for r in tr.trips_chronological(trips, 2).collect()] == [4, 1]


def test_chronological_order_is_total(fixture_trips):
    rows = tr.trips_chronological(fixture_trips).select("start_ts", "trip_id").collect()
    assert rows == sorted(rows)
    assert len(rows) == fixture_trips.count()
    assert isinstance(rows[0].start_ts, dt.datetime)


def test_samples_are_repeatable(fixture_trips):
    first = {r.trip_id for r in filters.sample_trips(fixture_trips, 0.2).select("trip_id").collect()}
    again = {r.trip_id for r in filters.sample_trips(fixture_trips, 0.2).select("trip_id").collect()}
    assert first == again and 0.1 < len(first) / fixture_trips.count() < 0.3
    copies = filters.bootstrap_points(fixture_trips, 1.0).groupBy("trip_id").count()
    assert copies.agg(F.max("count")).first()[0] > 1
