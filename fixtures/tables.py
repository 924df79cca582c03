"""The test tables as the library's inputs. Whole tables are used; every rule is per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmetrics.functions import TIMESTAMP_FORMAT, truncate_time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _props_k() -> Column:
    """The number in ``{"k": 12}``, the only field there is. Cheaper than a JSON parser, which the good-trip
    filter would call several times for each row."""
    return F.translate("props", '{}"k: ', "").cast("int")


def _shifted(ts: Column, months: int) -> Column:
    """``ts`` moved by 0 to ``months - 1`` whole months, by event."""
    return ts + F.make_ym_interval(F.lit(0), (F.col("event_id") % months).cast("int"))


def trips_raw(spark: SparkSession, sf_dir: str, start_unit: str = "second") -> DataFrame:
    """Raw taxi trips from ``events``: times as text, NULL and zero numbers, trips that break each rule."""
    event, k = F.col("event_id"), _props_k()
    start = _shifted(truncate_time(F.col("ts"), start_unit), 36)
    end = start + F.make_dt_interval(F.lit(0), F.lit(0), k, F.lit(0))
    fare = F.col("value") * 5
    return table(spark, sf_dir, "events").select(
        event.alias("trip_id"),
        F.col("user_id").alias("taxi_id"),
        F.date_format(start, TIMESTAMP_FORMAT).alias("start_text"),
        F.date_format(end, TIMESTAMP_FORMAT).alias("end_text"),
        F.nullif(k * 60, F.lit(0)).alias("trip_seconds"),
        F.when(event % 1009 == 5, F.lit(1200.5)).otherwise((event % 97).cast("double") / 3).alias("trip_miles"),
        F.when(event % 101 != 7, fare).alias("fare"),
        F.when(event % 7 != 0, fare * (event % 25) / 100).alias("tips"),
    )


def trips_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trips_raw`` as a CSV export with headers: some fares with a currency sign, all seconds with decimals, some
    miles that are no number, and some tips of words."""
    event = F.col("trip_id")
    as_text = lambda c: F.col(c).cast("string")
    return trips_raw(spark, sf_dir).select(
        F.col("trip_id").alias("Trip ID"),
        F.col("taxi_id").alias("Taxi ID"),
        F.col("start_text").alias("Trip Start Timestamp"),
        F.col("end_text").alias("Trip End Timestamp"),
        F.concat(as_text("trip_seconds"), F.lit(".0")).alias("Trip Seconds"),
        F.when(event % 11 == 3, F.lit("NaN")).otherwise(as_text("trip_miles")).alias("Trip Miles"),
        F.when(event % 13 == 4, F.concat(F.lit("$"), as_text("fare"))).otherwise(as_text("fare")).alias("Fare"),
        F.when(event % 17 == 5, F.lit("none")).otherwise(as_text("tips")).alias("Tips"),
    )


def _lines(df: DataFrame, event: Column) -> DataFrame:
    """The rows of an export as lines of text under a header line; some lack their last two fields, some have one more."""
    fields = F.array(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns])
    fields = F.when(event % 19 == 6, F.slice(fields, 1, len(df.columns) - 2)).otherwise(fields)
    fields = F.when((event % 19 != 6) & (event % 23 == 8), F.array_append(fields, F.lit("more"))).otherwise(fields)
    return df.select(F.array_join(fields, ",").alias(",".join(df.columns)))


def write_lines(lines: DataFrame, path: str) -> None:
    """As they are: nothing is quoted, and every file begins with the header."""
    lines.write.option("header", True).option("sep", "\x01").option("quote", "").csv(path)


def trips_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(trips_text(spark, sf_dir), F.col("Trip ID"))


def weather_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("measurement_id").cast("bigint")
    rain = F.when(event % 29 == 3, F.concat(F.col("interval_rain").cast("string"), F.lit("mm")))
    export = weather_raw(spark, sf_dir).select(
        F.col("measurement_id").alias("Measurement ID"),
        F.col("station").alias("Station Name"),
        F.col("measured_text").alias("Measurement Timestamp"),
        rain.otherwise(F.col("interval_rain").cast("string")).alias("Interval Rain"),
        F.col("intensity").alias("Rain Intensity"),
    )
    return _lines(export, F.col("Measurement ID").cast("bigint"))


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw weather measurements from ``events``, hourly, over six months and three stations."""
    measured = _shifted(truncate_time(F.col("ts"), "hour"), 6)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("measurement_id"),
        F.concat(F.lit("Station "), (F.col("user_id") % 3).cast("string"), F.lit(" St")).alias("station"),
        F.date_format(measured, TIMESTAMP_FORMAT).alias("measured_text"),
        F.when(F.col("event_id") % 5 != 0, F.col("value") / 100).alias("interval_rain"),
        (_props_k().cast("double") / 10).alias("intensity"),
    )


def _centroid(i: int) -> Column:
    """Element ``i`` as degrees on a grid of hundredths, so that trips share positions."""
    hundredths = F.floor(F.col("embedding")[i].cast("double") * 100 + 0.5).cast("int")
    return hundredths / F.lit(100).cast("double")


def trip_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with positions from ``embeddings``; the start is missing where the label is 0."""
    known = F.col("label") != 0
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("trip_id"),
        F.when(known, _centroid(0)).alias("start_lat"),
        F.when(known, _centroid(1)).alias("start_lng"),
        _centroid(2).alias("end_lat"),
        _centroid(3).alias("end_lng"),
    )


def zip_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A postcode reference from ``embeddings``, one postcode for each row."""
    return table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") + 60000).cast("int").alias("zip"),
        F.col("embedding")[0].cast("double").alias("lat"),
        F.col("embedding")[1].cast("double").alias("lng"),
    )
