"""Answer every question about one set of files and write each answer as a Parquet table.

    spark-submit tripmetrics/plans/report.py --trips s3a://bucket/trips.csv --weather s3a://bucket/weather.csv \\
        --zips s3a://bucket/zips.csv --out s3a://bucket/report --year 2018

The CSV is parsed once, into a stage table partitioned by year under ``OUT/stages/trips``; ``--trip-stage``
uses such a table from an earlier run instead. Rows with too few or too many fields are no trips: they are counted in
``quality_summary``, and their texts are written to ``broken_records``. All intermediate tables go to ``OUT/stages``;
those of a group of answers are removed when its answers are written.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession

from tripmetrics.operators.filters import good_trips
from tripmetrics.operators.rain import rain_by_time
from tripmetrics.operators.records import POSITION_COLUMNS, normalize_trips, rain_records
from tripmetrics.plans import questions
from tripmetrics.session import build_session
from tripmetrics.sources import (
    load_stage,
    read_trips,
    read_weather,
    read_zips,
    remove_stage,
    save_stage,
    stage,
    whole_records,
)


def run(
    spark: SparkSession,
    out: str,
    trips_csv: str | None = None,
    trip_stage: str | None = None,
    weather_csv: str | None = None,
    zips_csv: str | None = None,
    year: int = 2018,
    clusters: int = 308,
    rain_unit: str | None = None,
) -> list[str]:
    """Write the answers under ``out`` and return their names. Questions without input are left out.

    Each group of answers is written as soon as it is built, so what is answered stays if a later group fails.
    Intermediate tables go to ``out/stages``: a group's are removed with the group, only ``trips`` stays, for later runs.
    """
    stages = f"{out.rstrip('/')}/stages"
    if trip_stage is None:
        if trips_csv is None:
            raise ValueError("give the trips as CSV or as a stage table")
        trip_stage = f"{stages}/trips"
        save_trips(normalize_trips(read_trips(spark, trips_csv, flag_unreadable=True)), trip_stage)
    everything = load_stage(spark, trip_stage)
    trips = whole_records(everything)
    good = good_trips(trips)

    groups = [
        lambda folder: questions.record_counts(everything, folder=folder),
        lambda folder: questions.taxi_revenue(good, year, folder),
        lambda folder: questions.hours_of_day(good, folder),
        lambda folder: questions.tips(good),
    ]
    if all(c in trips.columns for c in POSITION_COLUMNS):
        groups.append(lambda folder: questions.pickup_hotspots(good, clusters, folder))
        if zips_csv is not None:
            groups.append(lambda folder: questions.postcode_pairs(good, read_zips(spark, zips_csv), folder=folder))
    if weather_csv is not None:
        groups.append(lambda folder: _rain_answers(spark, good, weather_csv, rain_unit, folder))

    names: list[str] = []
    for i, group in enumerate(groups):
        folder = f"{stages}/group-{i}"
        try:
            for name, answer in group(folder).items():
                answer.write.mode("overwrite").parquet(f"{out}/{name}")
                names.append(name)
        finally:
            remove_stage(spark, folder)
    return names


def save_trips(trips: DataFrame, path: str) -> None:
    """The stage table of trips: a folder per year, in each file by taxi and start, and searchable by taxi.

    Spark hands no filter on a zone-less time to Parquet, so order by time alone would skip nothing; years are folders.
    """
    save_stage(trips, path, partition_by="year", sort_by=("taxi_id", "start_ts"), look_up=("taxi_id",))


def _rain_answers(spark: SparkSession, good: DataFrame, path: str, unit: str | None, folder: str) -> questions.Answers:
    means = stage(rain_by_time(rain_records(read_weather(spark, path)), unit), "rain", folder)
    return questions.rainfall(means) | questions.rain_and_money(good, means, unit, folder)


def main() -> None:
    parser = argparse.ArgumentParser(description="Answer all trip and rain questions.")
    parser.add_argument("--trips", help="trip CSV")
    parser.add_argument("--trip-stage", help="stage table from an earlier run, instead of --trips")
    parser.add_argument("--weather", help="weather CSV")
    parser.add_argument("--zips", help="postcode CSV with the columns zip, lat, lng")
    parser.add_argument("--out", required=True, help="folder for the answers")
    parser.add_argument("--year", type=int, default=2018, help="year of the top-taxi questions")
    parser.add_argument("--clusters", type=int, default=308, help="number of pickup clusters")
    parser.add_argument("--rain-unit", help="match trips and rain by a whole unit such as hour")
    args = parser.parse_args()

    spark = build_session("tripmetrics-report")
    began = time.perf_counter()
    run(
        spark,
        args.out,
        trips_csv=args.trips,
        trip_stage=args.trip_stage,
        weather_csv=args.weather,
        zips_csv=args.zips,
        year=args.year,
        clusters=args.clusters,
        rain_unit=args.rain_unit,
    )
    print(f"answers written in {time.perf_counter() - began:.1f} s")
    spark.stop()


if __name__ == "__main__":
    main()
