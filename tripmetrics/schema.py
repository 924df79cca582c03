"""Declared input schemas: the CSV headers that are read and the column names used from there on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceColumn:
    """One CSV column: its header text, its name in this library and its type."""

    header: str
    name: str
    type: T.DataType
    required: bool = True


# Header texts of the two public CSV exports.
TRIP_COLUMNS = (
    SourceColumn("Trip ID", "trip_id", T.StringType(), required=False),
    SourceColumn("Taxi ID", "taxi_id", T.StringType()),
    SourceColumn("Trip Start Timestamp", "start_text", T.StringType()),
    SourceColumn("Trip End Timestamp", "end_text", T.StringType()),
    SourceColumn("Trip Seconds", "trip_seconds", T.IntegerType()),
    SourceColumn("Trip Miles", "trip_miles", T.DoubleType()),
    SourceColumn("Fare", "fare", T.DoubleType()),
    SourceColumn("Tips", "tips", T.DoubleType()),
    SourceColumn("Pickup Centroid Latitude", "start_lat", T.DoubleType(), required=False),
    SourceColumn("Pickup Centroid Longitude", "start_lng", T.DoubleType(), required=False),
    SourceColumn("Dropoff Centroid Latitude", "end_lat", T.DoubleType(), required=False),
    SourceColumn("Dropoff Centroid Longitude", "end_lng", T.DoubleType(), required=False),
)

WEATHER_COLUMNS = (
    SourceColumn("Measurement ID", "measurement_id", T.StringType()),
    SourceColumn("Station Name", "station", T.StringType()),
    SourceColumn("Measurement Timestamp", "measured_text", T.StringType()),
    SourceColumn("Interval Rain", "interval_rain", T.DoubleType()),
    SourceColumn("Rain Intensity", "intensity", T.DoubleType()),
)

ZIP_COLUMNS = (
    SourceColumn("zip", "zip", T.IntegerType()),
    SourceColumn("lat", "lat", T.DoubleType()),
    SourceColumn("lng", "lng", T.DoubleType()),
)


def struct(columns: tuple[SourceColumn, ...]) -> T.StructType:
    """The table as it looks after reading: library names and declared types."""
    return T.StructType([T.StructField(c.name, c.type) for c in columns])


TRIPS = struct(TRIP_COLUMNS)
WEATHER = struct(WEATHER_COLUMNS)
ZIP_REF = struct(ZIP_COLUMNS)
