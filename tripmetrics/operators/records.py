"""Projections: from raw rows to typed, cleaned records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics import functions as tm

POSITION_COLUMNS = ("start_lat", "start_lng", "end_lat", "end_lng")


def normalize_trips(raw: DataFrame) -> DataFrame:
    """Parse and clean raw trips once.

    Missing numbers become 0, times become ``timestamp_ntz`` (NULL if unreadable), and speed, midpoint
    hour and start year are added. Position columns, the names of unreadable fields and the text of broken rows pass
    through, NULLs kept. Columns that a query does not use cost nothing: Catalyst prunes them with their parsing.
    """
    passed_on = [c for c in (*POSITION_COLUMNS, "unreadable", "broken") if c in raw.columns]
    typed = raw.select(
        "trip_id",
        "taxi_id",
        tm.parse_time(F.col("start_text")).alias("start_ts"),
        tm.parse_time(F.col("end_text")).alias("end_ts"),
        *[tm.or_zero(F.col(c)).alias(c) for c in ("trip_seconds", "trip_miles", "fare", "tips")],
        *passed_on,
    )
    return typed.select(
        "*",
        tm.speed_mph(F.col("trip_miles"), F.col("trip_seconds")).alias("speed_mph"),
        tm.midpoint_hour(F.col("start_ts"), F.col("end_ts")).alias("midpoint_hour"),
        F.year("start_ts").alias("year"),
    )


def prepared_trips(trips: DataFrame) -> DataFrame:
    """The record behind the hour-of-day, tip and rain questions."""
    return trips.select(
        "trip_id", "fare", "tips", "speed_mph", "start_ts", "end_ts", "midpoint_hour", "trip_miles"
    )


def tip_records(trips: DataFrame) -> DataFrame:
    """Tip per mile and tip percentage of each trip, with its month."""
    return trips.select(
        "trip_id",
        "start_ts",
        F.month("start_ts").alias("month"),
        tm.month_name(F.col("start_ts")).alias("month_name"),
        "fare",
        "tips",
        tm.tip_per_mile(F.col("tips"), F.col("trip_miles")).alias("tip_per_mile"),
        tm.tip_pct(F.col("tips"), F.col("fare")).alias("tip_pct"),
    )


def trip_coordinates(trips: DataFrame) -> DataFrame:
    """Where each trip starts and ends; a missing position stays NULL."""
    ids = [c for c in ("trip_id", "start_ts") if c in trips.columns]
    return trips.select(*ids, *POSITION_COLUMNS)


def rain_records(raw: DataFrame) -> DataFrame:
    """Weather measurements with parsed time, spaces taken out of the station name, missing rain as 0."""
    return raw.select(
        "measurement_id",
        tm.squeeze_spaces(F.col("station")).alias("station"),
        tm.parse_time(F.col("measured_text")).alias("measured_ts"),
        tm.or_zero(F.col("interval_rain")).alias("interval_rain"),
        tm.or_zero(F.col("intensity")).alias("intensity"),
    )
