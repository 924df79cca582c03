"""The report job end to end, from CSV files to answer tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from fixtures import tables
from tripmetrics.operators import filters, records, zips
from tripmetrics.operators import trips as tr
from tripmetrics.plans import questions, report
from tripmetrics.schema import TRIP_COLUMNS, WEATHER_COLUMNS
from tripmetrics.sources import load_stage, read_trips, save_stage, stage

ANSWERS = {
    "broken_records", "trip_count", "trips_by_year", "quality_summary", "good_trips_by_year",
    "taxi_revenue_per_trip", "taxi_revenue_per_day", "top_taxis_per_trip", "top_taxi_total",
    "hourly_means", "hourly_totals", "hourly_peaks", "hourly_total_peaks", "metric_maxima",
    "overall_tip_pct", "top_tips_per_mile", "first_trips", "monthly_tip_means",
    "point_bounds", "cluster_centers", "cluster_hotspots", "cluster_silhouette",
    "zip_pairs", "rain_by_time", "rain_peaks", "time_money_corr", "rain_money_corr",
}


@pytest.fixture(scope="module")
def inputs(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("report")

    def write(df, name, columns):
        path = str(folder / name)
        headers = {c.name: c.header for c in columns if c.name in df.columns}
        df.withColumnsRenamed(headers).write.option("header", True).csv(path)
        return path

    trips = tables.trips_raw(spark, sf_dir).join(tables.trip_points(spark, sf_dir), "trip_id", "left")
    return {
        "out": str(folder / "out"),
        "trips_csv": write(trips, "trips", TRIP_COLUMNS),
        "weather_csv": write(tables.weather_raw(spark, sf_dir), "weather", WEATHER_COLUMNS),
        "zips_csv": write(tables.zip_reference(spark, sf_dir), "zips", ()),
    }


def test_report(spark, sf_dir, inputs):
    names = report.run(spark, **inputs, year=2025, clusters=5, rain_unit="hour")
    assert set(names) == ANSWERS

    def answer(name):
        return spark.read.parquet(f"{inputs['out']}/{name}")

    total = tables.trips_raw(spark, sf_dir).count()
    assert answer("trip_count").first().trips == total
    assert answer("quality_summary").first().trips == total
    assert answer("hourly_means").count() == 24
    assert answer("cluster_centers").count() == 5
    assert answer("top_taxis_per_trip").count() == 6
    assert answer("zip_pairs").count() > 0
    assert answer("rain_money_corr").count() == 1
    assert answer("broken_records").count() == answer("quality_summary").first().broken == 0
    # What the groups of answers staged is gone; the trips stay for later runs.
    assert [p.name for p in (Path(inputs["out"]) / "stages").iterdir()] == ["trips"]

    again = {**inputs, "trips_csv": None, "trip_stage": f"{inputs['out']}/stages/trips", "zips_csv": None}
    again["out"] = inputs["out"] + "-again"
    assert set(report.run(spark, **again, year=2025, clusters=5)) == ANSWERS - {"zip_pairs"}


def test_report_needs_trips(spark, tmp_path):
    with pytest.raises(ValueError, match="trips"):
        report.run(spark, str(tmp_path))


def small_csv(tmp_path, positions, n=40):
    """Trips with the given pickup positions in turn; without positions there are no such columns."""
    header = "Trip ID,Taxi ID,Trip Start Timestamp,Trip End Timestamp,Trip Seconds,Trip Miles,Fare,Tips"
    rows = []
    for i in range(n):
        row = f"{i},00{i % 3},01/0{i % 9 + 1}/2025 01:15:00 PM,01/0{i % 9 + 1}/2025 01:45:00 PM,1800,{i}.5,$10,2.5"
        place = positions[i % len(positions)] if positions else None
        rows.append(row + (f",{place[0]},{place[1]},41.9,-87.6" if place else ""))
    if positions:
        header += ",Pickup Centroid Latitude,Pickup Centroid Longitude,Dropoff Centroid Latitude,Dropoff Centroid Longitude"
    path = tmp_path / "trips.csv"
    path.write_text("\n".join([header, *rows]) + "\n")
    return str(path)


@pytest.mark.parametrize(
    ("positions", "centres"),
    [([], 0), ([(41.8, -87.6)], 0), ([(41.8, -87.6), (41.9, -87.7), (41.7, -87.5)], 3)],
    ids=["no positions", "one position", "fewer positions than clusters"],
)
def test_report_answers_what_its_input_allows(spark, tmp_path, positions, centres):
    out = str(tmp_path / "out")
    names = report.run(spark, out, trips_csv=small_csv(tmp_path, positions), year=2025, clusters=8)
    assert set(names) == ANSWERS - {"zip_pairs", "rain_by_time", "rain_peaks", "time_money_corr", "rain_money_corr"}
    answer = lambda name: spark.read.parquet(f"{out}/{name}")
    summary = answer("quality_summary").first()
    assert (summary.trips, summary.good, summary.unreadable) == (40, 40, 40)
    assert answer("top_taxi_total").first().taxi_id in ("000", "001", "002")
    assert answer("cluster_centers").count() == centres
    assert answer("cluster_hotspots").count() == centres
    assert answer("cluster_centers").dtypes == [("cluster", "int"), ("lat", "double"), ("lng", "double")]
    assert len(answer("point_bounds").collect()) == 1


def test_broken_rows_are_counted_and_listed_and_no_trips(spark, tmp_path):
    path = small_csv(tmp_path, [(41.8, -87.6)])
    with open(path, "a") as out:
        out.write("100,000,01/01/2025 01:15:00 PM\n101,000,01/01/2025 01:15:00 PM,,60,1,5,5,1,2,3,4,extra\n")
    out = str(tmp_path / "out")
    report.run(spark, out, trips_csv=path, year=2025)
    answer = lambda name: spark.read.parquet(f"{out}/{name}")
    summary = answer("quality_summary").first()
    assert (summary.trips, summary.good, summary.broken) == (40, 40, 2)
    assert sorted(r.broken[:3] for r in answer("broken_records").collect()) == ["100", "101"]
    assert answer("trip_count").first().trips == 40 and answer("trips_by_year").first().trips == 40
    assert answer("taxi_revenue_per_trip").count() == 3


def test_answers_before_a_failing_group_are_kept(spark, tmp_path, monkeypatch):
    def fail(*_, **__):
        raise RuntimeError("no clusters today")

    monkeypatch.setattr(report.questions, "pickup_hotspots", fail)
    out = str(tmp_path / "out")
    with pytest.raises(RuntimeError):
        report.run(spark, out, trips_csv=small_csv(tmp_path, [(41.8, -87.6)]), year=2025)
    assert spark.read.parquet(f"{out}/monthly_tip_means").count() == 1


def test_folded_answers_equal_the_single_questions(spark, sf_dir, tmp_path):
    trips = records.normalize_trips(tables.trips_raw(spark, sf_dir))
    good = filters.good_trips(trips)
    folder = str(tmp_path)
    answers = {
        **questions.record_counts(trips, folder=folder),
        **questions.taxi_revenue(good, 2025, folder),
        **questions.hours_of_day(good, folder),
    }
    in_year = filters.year_slice(good, 2025)
    single = {
        "trip_count": tr.trip_count(trips),
        "trips_by_year": tr.trips_by_year(trips),
        "quality_summary": tr.quality_summary(trips),
        "good_trips_by_year": tr.trips_by_year(good),
        "taxi_revenue_per_trip": tr.taxi_revenue_per_trip(good),
        "top_taxis_per_trip": tr.top_taxis_per_trip(in_year),
        "top_taxi_total": tr.top_taxi_total(in_year),
        "hourly_means": tr.hourly_means(good),
        "hourly_totals": tr.hourly_totals(good),
        "overall_tip_pct": tr.overall_tip_pct(good),
    }
    for name, expected in single.items():
        assert answers[name].columns == expected.columns
        got, want = (sorted(map(tuple, df.collect()), key=str) for df in (answers[name], expected))
        assert [pytest.approx(w, rel=1e-12) for w in want] == got, name


def test_how_often_the_report_reads_the_trips(spark, sf_dir, inputs, tmp_path, monkeypatch):
    """Scans of the stage table, in written answers and in what is staged on the way; fitting reads counts only."""
    path = str(tmp_path / "trips")
    save_stage(records.normalize_trips(read_trips(spark, inputs["trips_csv"])), path, partition_by="year")
    scans = []
    note = lambda df: scans.append(df._jdf.queryExecution().executedPlan().toString().count(f"{path}]"))

    def counted(df, label, folder=None):
        note(df)
        return stage(df, label, folder)

    monkeypatch.setattr(questions, "stage", counted)
    monkeypatch.setattr(zips, "stage", counted)
    trips = load_stage(spark, path)
    good = filters.good_trips(trips)
    folder = str(tmp_path / "scratch")
    groups = (
        questions.record_counts(trips, folder=folder),
        questions.taxi_revenue(good, 2025, folder),
        questions.hours_of_day(good, folder),
        questions.tips(good),
        questions.pickup_hotspots(good, 5, folder),
    )
    for answer in (df for group in groups for df in group.values()):
        note(answer)
    assert sum(scans) == 8
