"""

Thin wiring only. Inputs are derived from whole test tables; aggregates are rounded here, for the
comparison, and not in the library.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmetrics import functions as tm
from fixtures import oracle, tables
from tripmetrics.operators import filters, hotspots, rain, records, trips, zips
from tripmetrics.session import use_utc
from tripmetrics.sources import (
    load_stage,
    read_trips,
    read_weather,
    record_summary,
    save_stage,
    scratch_path,
    stage,
    unreadable_fields,
)

SMOKE_DIR = "/root/testdata/sf0.001"
SLICE_YEAR = 2025
CLUSTERS = 10
# Larger than the default, which would pick about one row of the smallest tables.
SAMPLE_FRACTION = 0.01
# In degrees. Spark's fit ends when no centre moves by more than 1e-4; trips that change sides in that step add to it.
CENTRE_TOLERANCE = 1e-3


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round float aggregates. The shift keeps exact halves, whose last bit varies, on one side."""
    shift = 10.0 ** -(digits + 4)
    return df.withColumns({c: F.round(F.col(c) + shift, digits) for c in columns})


# Inputs


def _trips(spark: SparkSession, sf_dir: str, start_unit: str = "second") -> DataFrame:
    return records.normalize_trips(tables.trips_raw(spark, sf_dir, start_unit))


def _good(spark: SparkSession, sf_dir: str, start_unit: str = "second") -> DataFrame:
    return filters.good_trips(_trips(spark, sf_dir, start_unit))


def _tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.tip_records(_good(spark, sf_dir))


def _rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rain.rain_by_time(records.rain_records(tables.weather_raw(spark, sf_dir)))


def _joined(spark: SparkSession, sf_dir: str, unit: str | None, start_unit: str) -> DataFrame:
    means = stage(_rain(spark, sf_dir), "rain")
    return rain.trips_with_rain(_good(spark, sf_dir, start_unit), means, unit)


def _pickup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(hotspots.pickup_counts(tables.trip_points(spark, sf_dir)), "pickups")


def _trips_with_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trips(spark, sf_dir).join(tables.trip_points(spark, sf_dir), "trip_id")


def _nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = zips.trip_ends(tables.trip_points(spark, sf_dir))
    return zips.nearest_zips(ends, tables.zip_reference(spark, sf_dir))


# Queries that need more than one line


def _scan_csv_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "trips-csv")
    raw = tables.trips_raw(spark, sf_dir)
    headers = {
        "trip_id": "Trip ID",
        "taxi_id": "Taxi ID",
        "start_text": "Trip Start Timestamp",
        "end_text": "Trip End Timestamp",
        "trip_seconds": "Trip Seconds",
        "trip_miles": "Trip Miles",
        "fare": "Fare",
        "tips": "Tips",
    }
    raw.withColumnsRenamed(headers).write.option("header", True).csv(path)
    return read_trips(spark, path).select(*headers)


def _unreadable_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as text, some of them as no CSV reader takes them."""
    path = scratch_path(spark, "trips-text")
    tables.trips_text(spark, sf_dir).write.option("header", True).csv(path)
    return unreadable_fields(read_trips(spark, path, flag_unreadable=True))


def _counted(**rows: DataFrame) -> DataFrame:
    """One row per name with the number of rows of its table."""
    counts = [df.agg(F.lit(name).alias("name"), F.count("*").alias("rows")) for name, df in rows.items()]
    return functools.reduce(DataFrame.unionByName, counts)


def _sample_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the samples that the source has not, and ids that the sample without replacement repeats."""
    source, points = _trips(spark, sf_dir), tables.trip_points(spark, sf_dir)
    sample = filters.sample_trips(source, SAMPLE_FRACTION)
    # Times are left out: each of them would be parsed for the sample and for the source.
    fields = ["trip_id", "taxi_id", "trip_seconds", "trip_miles", "fare", "tips", "speed_mph"]
    return _counted(
        foreign=sample.join(_trips(spark, sf_dir), fields, "left_anti"),
        repeated=sample.groupBy("trip_id").count().where("count > 1"),
        foreign_points=filters.bootstrap_points(points).join(tables.trip_points(spark, sf_dir), "trip_id", "left_anti"),
    )


def _clustered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, KMeansModel, DataFrame]:
    counts = _pickup_counts(spark, sf_dir)
    model = hotspots.fit_clusters(counts, CLUSTERS)
    points = hotspots.cluster_points(model, tables.trip_points(spark, sf_dir))
    return points, model, hotspots.cluster_hotspots(model, counts)


def _cluster_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with a cluster, those that another centre is nearer to, and known positions that got none."""
    points, model, _ = _clustered(spark, sf_dir)
    off = [
        (F.col("start_lat") - float(lat)) ** 2 + (F.col("start_lng") - float(lng)) ** 2
        for lat, lng in model.clusterCenters()
    ]
    nearer = F.least(*off) < F.get(F.array(*off), F.col("cluster")) - 1e-9
    known = filters.valid_points(tables.trip_points(spark, sf_dir))
    return _counted(
        assigned=points,
        not_nearest=points.where(nearer),
        left_out=known.join(points, "trip_id", "left_anti"),
    )


def _hotspot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hotspots without their cluster: trips by position."""
    return _clustered(spark, sf_dir)[2].groupBy("start_lat", "start_lng").agg(F.sum("trips").alias("trips"))


def _centre_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centres, those that are not the mean of their trips, and hotspots that are listed before a busier one.

    A fit ends when no centre moves by more than its tolerance; what its last step moved is left between a centre and
    the mean of its trips.
    """
    counts = _pickup_counts(spark, sf_dir)
    model = hotspots.fit_clusters(counts, CLUSTERS, max_iter=200)
    listed = hotspots.cluster_hotspots(model, counts)
    mean = [(F.sum(F.col(c) * F.col("trips")) / F.sum("trips")).alias(c) for c in hotspots.START]
    means = listed.groupBy("cluster").agg(*mean)
    off = (F.col("start_lat") - F.col("lat")) ** 2 + (F.col("start_lng") - F.col("lng")) ** 2
    centres = hotspots.cluster_centers(spark, model)
    # Rows of a sorted table are in order within and over its parts.
    placed = listed.select("trips", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    inside = F.lag("trips").over(W.partitionBy("part").orderBy("at"))
    parts = placed.groupBy("part").agg(F.max("trips").alias("trips"), F.min("trips").alias("least"))
    between = F.lag("least").over(W.orderBy("part"))
    return _counted(
        centres=centres,
        not_mean=centres.join(means, "cluster").where(off > CENTRE_TOLERANCE**2),
        out_of_order=placed.withColumn("before", inside).where("trips > before"),
        parts_out_of_order=parts.withColumn("before", between).where("trips > before"),
    )


def _silhouette_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silhouettes out of their range, and those that are not what Spark's evaluator finds on the single trips."""
    points, model, _ = _clustered(spark, sf_dir)
    own = hotspots.cluster_silhouette(model, _pickup_counts(spark, sf_dir))
    features = VectorAssembler(inputCols=list(hotspots.START), outputCol="features").transform(points)
    expected = ClusteringEvaluator(predictionCol="cluster").evaluate(features)
    return _counted(
        out_of_range=own.where("abs(silhouette) > 1 OR silhouette IS NULL"),
        not_equal=own.where(F.abs(F.col("silhouette") - expected) > 1e-9),
    )


def _broken_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole and broken rows of both exports, and whole rows with an unreadable field."""
    found = []
    for name, lines, read in (
        ("trips", tables.trips_lines, read_trips),
        ("weather", tables.weather_lines, read_weather),
    ):
        path = scratch_path(spark, f"{name}-lines")
        tables.write_lines(lines(spark, sf_dir), path)
        flagged = read(spark, path, flag_unreadable=True)
        found.append(record_summary(flagged).select(F.lit(name).alias("name"), "whole", "broken", "unreadable"))
    return functools.reduce(DataFrame.unionByName, found)


def _quality_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality summary of an export with broken rows."""
    path = scratch_path(spark, "trips-lines")
    tables.write_lines(tables.trips_lines(spark, sf_dir), path)
    trips_read = records.normalize_trips(read_trips(spark, path, flag_unreadable=True))
    return _rounded(trips.quality_summary(trips_read), 6, "bad_pct")


def _scan_csv_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "weather-csv")
    headers = {
        "measurement_id": "Measurement ID",
        "station": "Station Name",
        "measured_text": "Measurement Timestamp",
        "interval_rain": "Interval Rain",
        "intensity": "Rain Intensity",
    }
    tables.weather_raw(spark, sf_dir).withColumnsRenamed(headers).write.option("header", True).csv(path)
    return read_weather(spark, path)


def _stage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "trips")
    save_stage(_trips(spark, sf_dir), path, partition_by="year")
    return load_stage(spark, path)


def _cluster_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = hotspots.fit_clusters(_pickup_counts(spark, sf_dir), CLUSTERS)
    return hotspots.cluster_points(model, tables.trip_points(spark, sf_dir))


def _cluster_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotspots.cluster_centers(spark, hotspots.fit_clusters(_pickup_counts(spark, sf_dir), CLUSTERS))


def _cluster_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _pickup_counts(spark, sf_dir)
    return hotspots.cluster_hotspots(hotspots.fit_clusters(counts, CLUSTERS), counts)


def _cluster_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _pickup_counts(spark, sf_dir)
    return hotspots.cluster_silhouette(hotspots.fit_clusters(counts, CLUSTERS), counts)


def _zip_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per trip and pair, because SQL engines compare rows more safely than arrays of structs."""
    lists = stage(zips.zip_lists(_nearest(spark, sf_dir)), "zips")
    pairs = zips.zip_pairs(tables.trip_points(spark, sf_dir), lists)
    return pairs.select("trip_id", F.inline("zip_pairs"))


_MEANS = ("speed_mph", "fare", "tips")
_RAIN = ("interval_rain", "intensity")

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources
    "scan_csv_trips": _scan_csv_trips,
    "scan_csv_weather": _scan_csv_weather,
    "unreadable_fields": _unreadable_fields,
    "broken_records": _broken_records,
    "quality_of_lines": _quality_of_lines,
    "stage_roundtrip": _stage_roundtrip,
    # projections
    "trip_defaults": lambda s, d: _trips(s, d).select("trip_id", "trip_seconds", "trip_miles", "fare", "tips"),
    "trip_times": lambda s, d: _trips(s, d).select("trip_id", "start_ts", "end_ts"),
    "trip_year": lambda s, d: _trips(s, d).select("trip_id", "year"),
    "trip_speed": lambda s, d: _trips(s, d).select("trip_id", "speed_mph"),
    "trip_midpoint_hour": lambda s, d: _trips(s, d).select("trip_id", "midpoint_hour"),
    "trip_revenue": lambda s, d: _trips(s, d).select(
        "trip_id", tm.revenue(F.col("fare"), F.col("tips")).alias("revenue")
    ),
    "trip_tip_pct": lambda s, d: _tips(s, d).select("trip_id", "tip_pct"),
    "trip_tip_per_mile": lambda s, d: _tips(s, d).select("trip_id", "tip_per_mile"),
    "trip_month_name": lambda s, d: _tips(s, d).select("trip_id", "month", "month_name"),
    "prepared_trips": lambda s, d: records.prepared_trips(_good(s, d)),
    "tip_records": _tips,
    "trip_coordinates": lambda s, d: records.trip_coordinates(_trips_with_points(s, d)),
    "rain_records": lambda s, d: records.rain_records(tables.weather_raw(s, d)),
    "trip_unix_time": lambda s, d: _trips(s, d).select(
        "trip_id", tm.epoch_seconds(F.col("start_ts")).alias("unix_time")
    ),
    # filters and samples
    "good_trips": _good,
    "year_slice": lambda s, d: filters.year_slice(_good(s, d), SLICE_YEAR, staged=False),
    "taxi_slice": lambda s, d: filters.taxi_slice(_good(s, d), 7).select(
        "trip_id", "taxi_id", "start_ts", "fare", "tips"
    ),
    "valid_points": lambda s, d: filters.valid_points(tables.trip_points(s, d)),
    "sample_trips": lambda s, d: filters.sample_trips(_trips(s, d), SAMPLE_FRACTION),
    "bootstrap_points": lambda s, d: filters.bootstrap_points(tables.trip_points(s, d)),
    "sample_check": _sample_check,
    # counts and quality
    "trip_count": lambda s, d: trips.trip_count(_trips(s, d)),
    "trips_by_year": lambda s, d: trips.trips_by_year(_trips(s, d)),
    "good_trips_by_year": lambda s, d: trips.trips_by_year(_good(s, d)),
    "quality_summary": lambda s, d: _rounded(trips.quality_summary(_trips(s, d)), 6, "bad_pct"),
    # revenue
    "taxi_revenue_per_trip": lambda s, d: _rounded(trips.taxi_revenue_per_trip(_good(s, d)), 6, "revenue_per_trip"),
    "taxi_revenue_per_day": lambda s, d: _rounded(trips.taxi_revenue_per_day(_good(s, d)), 6, "revenue_per_day"),
    "top_taxis_per_trip": lambda s, d: _rounded(trips.top_taxis_per_trip(_good(s, d)), 6, "revenue_per_trip"),
    "top_taxi_total": lambda s, d: _rounded(
        trips.top_taxi_total(filters.year_slice(_good(s, d), SLICE_YEAR, staged=False)), 4, "revenue"
    ),
    # hour of day
    "hourly_means": lambda s, d: _rounded(trips.hourly_means(_good(s, d)), 6, *_MEANS),
    "hourly_totals": lambda s, d: _rounded(trips.hourly_totals(_good(s, d)), 4, "fare", "tips"),
    "hourly_peaks": lambda s, d: _rounded(trips.hourly_peaks(trips.hourly_means(_good(s, d))), 6, *_MEANS),
    "hourly_total_peaks": lambda s, d: _rounded(
        trips.hourly_total_peaks(trips.hourly_totals(_good(s, d))), 4, "fare", "tips"
    ),
    "metric_maxima": lambda s, d: _rounded(trips.metric_maxima(trips.hourly_means(_good(s, d))), 6, *_MEANS),
    # tips
    "overall_tip_pct": lambda s, d: _rounded(trips.overall_tip_pct(_good(s, d)), 6, "tip_pct"),
    "monthly_tip_means": lambda s, d: _rounded(
        trips.monthly_tip_means(_tips(s, d)), 6, "fare", "tips", "tip_per_mile", "tip_pct"
    ),
    "top_tips_per_mile": lambda s, d: trips.top_tips_per_mile(_good(s, d)),
    "trips_chronological": lambda s, d: trips.trips_chronological(_good(s, d)),
    "first_trips": lambda s, d: trips.trips_chronological(_good(s, d), 10),
    # rain
    "rain_by_time": lambda s, d: _rounded(_rain(s, d), 6, *_RAIN),
    "rain_peaks": lambda s, d: _rounded(rain.rain_peaks(_rain(s, d)), 6, *_RAIN),
    "trips_with_rain": lambda s, d: _rounded(_joined(s, d, None, "hour"), 6, *_RAIN),
    "trips_with_rain_hourly": lambda s, d: _rounded(_joined(s, d, "hour", "second"), 6, *_RAIN),
    "time_money_corr": lambda s, d: _rounded(
        rain.time_money_corr(_joined(s, d, "hour", "second")), 6, "time_fare_corr", "time_tips_corr"
    ),
    "rain_money_corr": lambda s, d: _rounded(
        rain.rain_money_corr(_joined(s, d, "hour", "second")),
        6,
        *[f"{r}_{m}_corr" for r in _RAIN for m in ("fare", "tips")],
    ),
    # positions
    "pickup_counts": lambda s, d: hotspots.pickup_counts(tables.trip_points(s, d)),
    "point_bounds": lambda s, d: hotspots.point_bounds(tables.trip_points(s, d)),
    "cluster_points": _cluster_points,
    "cluster_centers": _cluster_centers,
    "cluster_hotspots": _cluster_hotspots,
    "cluster_silhouette": _cluster_silhouette,
    "cluster_check": _cluster_check,
    "hotspot_check": _hotspot_check,
    "centre_check": _centre_check,
    "silhouette_check": _silhouette_check,
    "nearest_zips": lambda s, d: _rounded(_nearest(s, d), 6, "miles"),
    "zip_pairs": _zip_pairs,
}


try:
    import corpus_pipeline
    from tripmetrics.llm import oracle as llm_oracle
    from tripmetrics.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    # Only their absence is fine; a module that they need and that is missing is an error.
    if missing.name not in ("corpus_pipeline", "tripmetrics.llm"):
        raise
    _LLM_QUERIES, _LLM_SQL = {}, {}
else:
    _LLM_QUERIES = {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}
    _LLM_SQL = dict(llm_oracle.SQL)
    if corpus_pipeline.ORACLE_SQL:
        _LLM_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


def _in_utc(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(use_utc(spark), sf_dir)


def entry(spark: SparkSession) -> DataFrame:
    """Mean speed, fare and tip by hour of the trip's midpoint, on good trips."""
    return queries()["hourly_means"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _in_utc(query) for name, query in {**_QUERIES, **_LLM_QUERIES}.items()}


def oracle_sql() -> dict[str, str]:
    """The same questions as SQL. K-means results have none: they are not unique answers."""
    return {**oracle.oracle_sql(), **_LLM_SQL}
