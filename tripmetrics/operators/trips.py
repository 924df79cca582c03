"""Counts, means, totals and top lists over trips.

Every aggregate combines on the map side, so what is shuffled depends on the number of groups and not
on how many trips the largest group has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics import functions as tm
from tripmetrics.operators.filters import QualityRules
from tripmetrics.operators.grouping import group_known
from tripmetrics.operators.peaks import peak_rows
from tripmetrics.operators.records import tip_records

HOURLY_METRICS = ("speed_mph", "fare", "tips")


def trip_count(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count("*").alias("trips"))


def trips_by_year(trips: DataFrame) -> DataFrame:
    """Number of trips by start year; trips without a readable start are left out."""
    return group_known(trips, ["year"], "year", F.count("*").alias("trips"))


def quality_summary(trips: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """All, good and bad trips and the share of bad ones, from one scan.

    With the column ``unreadable`` of the CSV reader also the trips in which a filled field could not be read, and
    with ``broken`` the rows with too few or too many fields, which are neither trips nor counted as such.
    One aggregate over all rows: the start year, which would be parsed for each of them, plays no part.
    """
    return _summary(trips.agg(*_quality_counts(trips, rules)))


def _quality_counts(trips: DataFrame, rules: QualityRules) -> list[Column]:
    if "broken" not in trips.columns:
        counts = [F.count("*").alias("trips"), F.count_if(rules.is_good()).alias("good")]
        if "unreadable" in trips.columns:
            counts.append(F.count_if(F.size("unreadable") > 0).alias("unreadable"))
        return counts
    whole = F.col("broken").isNull()
    counts = [F.count_if(whole).alias("trips"), F.count_if(whole & rules.is_good()).alias("good")]
    if "unreadable" in trips.columns:
        counts.append(F.count_if(whole & (F.size("unreadable") > 0)).alias("unreadable"))
    return [*counts, F.count("broken").alias("broken")]


def counts_by_year(trips: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """All and good trips by start year, and those with unreadable fields and broken rows where that is known.

    One scan for all questions about counts; trips without a readable start are the row of the NULL year.
    """
    return trips.groupBy("year").agg(*_quality_counts(trips, rules))


def summary_of_years(years: DataFrame) -> DataFrame:
    """``quality_summary`` from ``counts_by_year``."""
    names = [c for c in years.columns if c != "year"]
    return _summary(years.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]))


def _summary(sums: DataFrame) -> DataFrame:
    bad = F.col("trips") - F.col("good")
    rest = [c for c in sums.columns if c not in ("trips", "good")]
    return sums.select("trips", "good", bad.alias("bad"), tm.share_pct(bad, F.col("trips")).alias("bad_pct"), *rest)


def _with_revenue(trips: DataFrame) -> DataFrame:
    return trips.withColumn("revenue", tm.revenue(F.col("fare"), F.col("tips")))


def taxi_revenue_per_trip(trips: DataFrame) -> DataFrame:
    """Mean revenue of a trip, by taxi."""
    return _with_revenue(trips).groupBy("taxi_id").agg(F.avg("revenue").alias("revenue_per_trip"))


def taxi_revenue_per_day(trips: DataFrame) -> DataFrame:
    """Revenue divided by the number of days on which the taxi had a trip.

    Summed by taxi and day first: the second aggregate then sees at most one row per taxi and day,
    so a taxi with a large share of all trips is spread over its days.
    """
    dated = _with_revenue(trips).withColumn("day", F.to_date("start_ts"))
    daily = group_known(dated, ["taxi_id", "day"], "day", F.sum("revenue").alias("revenue"))
    return daily.groupBy("taxi_id").agg(
        F.count("*").alias("days"), (F.sum("revenue") / F.count("*")).alias("revenue_per_day")
    )


def taxi_sums(trips: DataFrame, year: int) -> DataFrame:
    """Number of trips and revenue by taxi, in all and in ``year``: one scan for the questions about taxis."""
    in_year = F.col("year") == year
    return _with_revenue(trips).groupBy("taxi_id").agg(
        F.count("*").alias("trips"),
        F.sum("revenue").alias("revenue"),
        F.count_if(in_year).alias("year_trips"),
        F.sum(F.when(in_year, F.col("revenue"))).alias("year_revenue"),
    )


def taxi_revenue_total(trips: DataFrame) -> DataFrame:
    """Revenue by taxi."""
    return _with_revenue(trips).groupBy("taxi_id").agg(F.sum("revenue").alias("revenue"))


def top_taxis_per_trip(trips: DataFrame, n: int = 6) -> DataFrame:
    """The taxis with the highest mean revenue of a trip."""
    return taxi_revenue_per_trip(trips).orderBy(F.desc("revenue_per_trip"), "taxi_id").limit(n)


def top_taxi_total(trips: DataFrame, n: int = 1) -> DataFrame:
    """The taxi, or the ``n`` taxis, with the highest revenue; apply to a year's slice for one year."""
    return taxi_revenue_total(trips).orderBy(F.desc("revenue"), "taxi_id").limit(n)


def hourly_means(trips: DataFrame) -> DataFrame:
    """Mean speed, fare and tip by hour of the trip's midpoint."""
    return group_known(trips, ["midpoint_hour"], "midpoint_hour", *[F.avg(m).alias(m) for m in HOURLY_METRICS])


def hourly_totals(trips: DataFrame) -> DataFrame:
    """Total fare and tips by hour of the trip's midpoint."""
    totals = [F.sum(m).alias(m) for m in ("fare", "tips")]
    return group_known(trips, ["midpoint_hour"], "midpoint_hour", *totals)


def hourly_sums(trips: DataFrame) -> DataFrame:
    """Counts and sums by hour of the trip's midpoint, the NULL hour included: one scan for all hourly questions."""
    sums = [F.sum(m).alias(m) for m in HOURLY_METRICS]
    return trips.groupBy("midpoint_hour").agg(F.count("*").alias("trips"), *sums)


def means_of_sums(sums: DataFrame) -> DataFrame:
    """``hourly_means`` from ``hourly_sums``."""
    means = [(F.col(m) / F.col("trips")).alias(m) for m in HOURLY_METRICS]
    return sums.filter("midpoint_hour IS NOT NULL").select("midpoint_hour", *means)


def hourly_peaks(means: DataFrame) -> DataFrame:
    """The hour with the highest mean, for speed, fare and tips; takes ``hourly_means``."""
    return peak_rows(means, "midpoint_hour", HOURLY_METRICS)


def hourly_total_peaks(totals: DataFrame) -> DataFrame:
    """The hour in which drivers earn most, in fares and in tips; takes ``hourly_totals``."""
    return peak_rows(totals, "midpoint_hour", ("fare", "tips"))


def metric_maxima(means: DataFrame) -> DataFrame:
    """The highest hourly mean of each metric, without its hour; takes ``hourly_means``."""
    return means.agg(*[F.max(m).alias(m) for m in HOURLY_METRICS])


def overall_tip_pct(trips: DataFrame) -> DataFrame:
    """All tips as a percentage of all fares; 0 where there are no fares."""
    sums = trips.agg(F.sum("tips").alias("tips"), F.sum("fare").alias("fare"))
    return sums.select(tm.share_pct(F.col("tips"), F.col("fare")).alias("tip_pct"))


def monthly_tip_means(tips: DataFrame) -> DataFrame:
    """Means of ``tip_records`` by calendar month over the whole period.

    Grouped by the month's number; the name is made from it afterwards, for twelve rows.
    """
    metrics = ("fare", "tips", "tip_per_mile", "tip_pct")
    means = group_known(tips, ["month"], "month", *[F.avg(c).alias(c) for c in metrics])
    some_day = F.make_date(F.lit(2000), F.col("month"), F.lit(1))
    return means.select("month", tm.month_name(some_day).alias("month_name"), *metrics)


def top_tips_per_mile(trips: DataFrame, n: int = 10) -> DataFrame:
    """The ``tip_records`` of the trips with the best tip per mile.

    Keeps ``n`` trips per task instead of sorting all, and makes the records of the chosen trips only.
    """
    tip_per_mile = tm.tip_per_mile(F.col("tips"), F.col("trip_miles"))
    return tip_records(trips.orderBy(F.desc(tip_per_mile), "trip_id", "start_ts").limit(n))


def trips_chronological(trips: DataFrame, n: int | None = None) -> DataFrame:
    """The ``tip_records`` in order of the trips' start, all of them or the first ``n``.

    The trip id is part of the sort key, so trips that share one start time can be spread over several
    sorted partitions. Records are made after sorting, so only their source columns are moved.
    """
    ordered = trips.orderBy(F.asc_nulls_last("start_ts"), "trip_id")
    return tip_records(ordered if n is None else ordered.limit(n))
