"""One function per group of questions. Each returns named DataFrames; writing or collecting is the caller's choice.

``trips`` is always the result of ``normalize_trips`` and ``good`` that of ``good_trips``, best loaded from
a typed stage table: then every question reads its few columns only, and no time is parsed again. Questions of a
group that need the same sums take them from one scan, staged under ``folder`` (see ``scratch_path``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics import functions as tm
from tripmetrics.operators import filters, hotspots, rain, records, trips as tr, zips
from tripmetrics.sources import broken_records, stage

Answers = dict[str, DataFrame]


def record_counts(
    trips: DataFrame, rules: filters.QualityRules = filters.QualityRules(), folder: str | None = None
) -> Answers:
    """How many trips are there, in all and by year, how many are bad, and how many good ones by year?

    Takes a table with its broken rows, if it was read with them, and lists their texts as well.
    """
    years = stage(tr.counts_by_year(trips, rules), "years", folder)
    known = years.filter("year IS NOT NULL")
    quarantine = {"broken_records": broken_records(trips)} if "broken" in trips.columns else {}
    return quarantine | {
        "trip_count": years.agg(F.coalesce(F.sum("trips"), F.lit(0)).alias("trips")),
        "trips_by_year": known.filter("trips > 0").select("year", "trips"),
        "quality_summary": tr.summary_of_years(years),
        "good_trips_by_year": known.filter("good > 0").select("year", F.col("good").alias("trips")),
    }


def taxi_revenue(good: DataFrame, year: int, folder: str | None = None) -> Answers:
    """What does each taxi earn per trip and per day, and which earned most in ``year``?"""
    sums = stage(tr.taxi_sums(good, year), "taxis", folder)
    in_year = sums.filter("year_trips > 0")
    per_trip = (F.col("year_revenue") / F.col("year_trips")).alias("revenue_per_trip")
    total = in_year.select("taxi_id", F.col("year_revenue").alias("revenue"))
    return {
        "taxi_revenue_per_trip": sums.select("taxi_id", (F.col("revenue") / F.col("trips")).alias("revenue_per_trip")),
        "taxi_revenue_per_day": tr.taxi_revenue_per_day(good),
        "top_taxis_per_trip": in_year.select("taxi_id", per_trip).orderBy(F.desc("revenue_per_trip"), "taxi_id").limit(6),
        "top_taxi_total": total.orderBy(F.desc("revenue"), "taxi_id").limit(1),
    }


def hours_of_day(good: DataFrame, folder: str | None = None) -> Answers:
    """How fast are trips in each hour, in which hour do drivers earn most, and what share of fares are tips?

    The hourly sums have at most 25 rows; they are staged, so no question about them reads the trips again.
    """
    sums = stage(tr.hourly_sums(good), "hourly-sums", folder)
    means = stage(tr.means_of_sums(sums), "hourly-means", folder)
    totals = sums.filter("midpoint_hour IS NOT NULL").select("midpoint_hour", "fare", "tips")
    all_hours = sums.agg(F.sum("tips").alias("tips"), F.sum("fare").alias("fare"))
    return {
        "hourly_means": means,
        "hourly_totals": totals,
        "hourly_peaks": tr.hourly_peaks(means),
        "hourly_total_peaks": tr.hourly_total_peaks(totals),
        "metric_maxima": tr.metric_maxima(means),
        "overall_tip_pct": all_hours.select(tm.share_pct(F.col("tips"), F.col("fare")).alias("tip_pct")),
    }


def tips(good: DataFrame) -> Answers:
    """Which trips tipped best, which were first, and how do months differ?"""
    return {
        "top_tips_per_mile": tr.top_tips_per_mile(good),
        "first_trips": tr.trips_chronological(good, 10),
        "monthly_tip_means": tr.monthly_tip_means(records.tip_records(good)),
    }


def pickup_hotspots(good: DataFrame, clusters: int, folder: str | None = None) -> Answers:
    """Where do trips start? Runs the clustering jobs; tables are empty where there are under two positions."""
    counts = stage(hotspots.pickup_counts(good), "pickups", folder)
    answers = {"point_bounds": hotspots.point_bounds(counts)}
    if hotspots.can_cluster(counts):
        model = hotspots.fit_clusters(counts, clusters)
        found = (
            hotspots.cluster_centers(good.sparkSession, model),
            hotspots.cluster_hotspots(model, counts),
            hotspots.cluster_silhouette(model, counts),
        )
    else:
        found = hotspots.no_clusters(counts)
    return answers | dict(zip(("cluster_centers", "cluster_hotspots", "cluster_silhouette"), found))


def postcode_pairs(
    good: DataFrame, zip_reference: DataFrame, k: int = 5, max_miles: float | None = None, folder: str | None = None
) -> Answers:
    """Between which postcodes does each trip run?"""
    nearest = zips.nearest_zips(zips.trip_ends(good), zip_reference, k, max_miles, folder)
    lists = stage(zips.zip_lists(nearest), "zips", folder)
    return {"zip_pairs": zips.zip_pairs(good, lists)}


def rainfall(rain_means: DataFrame) -> Answers:
    """When did it rain most? Takes ``rain_by_time``, staged."""
    return {"rain_by_time": rain_means, "rain_peaks": rain.rain_peaks(rain_means)}


def rain_and_money(good: DataFrame, rain_means: DataFrame, unit: str | None = None, folder: str | None = None) -> Answers:
    """Do fares and tips go with time or with rain? Takes ``rain_by_time``, staged."""
    all_of_them = stage(rain.money_corr(rain.trips_with_rain(good, rain_means, unit)), "correlations", folder)
    of_time = [c for c in all_of_them.columns if c.startswith("time_")]
    return {
        "time_money_corr": all_of_them.select(*of_time),
        "rain_money_corr": all_of_them.drop(*of_time),
    }
