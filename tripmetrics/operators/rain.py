"""Rain by time, and rain joined with trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics import functions as tm
from tripmetrics.operators.grouping import group_known
from tripmetrics.operators.peaks import peak_rows

RAIN_METRICS = ("interval_rain", "intensity")


def rain_by_time(records: DataFrame, unit: str | None = None) -> DataFrame:
    """Mean rain over the stations by time, or by the whole ``unit`` (``'hour'``) the time lies in."""
    times = records.withColumn("measured_ts", tm.truncate_time(F.col("measured_ts"), unit))
    return group_known(times, ["measured_ts"], "measured_ts", *[F.avg(m).alias(m) for m in RAIN_METRICS])


def rain_peaks(rain: DataFrame) -> DataFrame:
    """The wettest time, by amount and by intensity; takes the result of ``rain_by_time``."""
    return peak_rows(rain, "measured_ts", RAIN_METRICS)


def _never(trip: Column) -> Column:
    """A time of no measurement, for trips without a readable start: it finds no rain.

    It keeps the join's key from being NULL. A test for NULL would be put into the filter below the join, where a time
    that comes from text is parsed once more. There are a thousand of them, so that very many such trips are no single key.
    """
    fraction = (F.pmod(F.xxhash64(trip), F.lit(1000)) + 1).cast("decimal(18, 6)") / 1_000_000
    spread = tm.year_one() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction.cast("decimal(18, 6)"))
    # The planner can't tell that the sum is never NULL, and can of a constant.
    return F.coalesce(spread, tm.year_one())


def trips_with_rain(trips: DataFrame, rain: DataFrame, unit: str | None = None) -> DataFrame:
    """Trips together with the rain at their start.

    ``rain`` has one row per time, so the join neither multiplies trips nor depends on how many trips
    start at one time. Rain means are few (one row per time in the period): pass them as a stage table,
    and the planner sees their size and broadcasts them instead of shuffling the trips.
    """
    at = F.coalesce(tm.truncate_time(F.col("start_ts"), unit), _never(F.col("trip_id")))
    started = trips.select("trip_id", at.alias("measured_ts"), "fare", "tips")
    joined = started.join(rain, "measured_ts", "inner")
    return joined.select(
        "trip_id",
        F.col("measured_ts").alias("rain_ts"),
        tm.epoch_seconds(F.col("measured_ts")).alias("unix_time"),
        *RAIN_METRICS,
        "fare",
        "tips",
    )


def _time_corr() -> list[Column]:
    return [tm.correlation(F.col("unix_time"), F.col(m)).alias(f"time_{m}_corr") for m in ("fare", "tips")]


def _rain_corr() -> list[Column]:
    return [
        tm.correlation(F.col(r), F.col(m)).alias(f"{r}_{m}_corr") for r in RAIN_METRICS for m in ("fare", "tips")
    ]


def time_money_corr(joined: DataFrame) -> DataFrame:
    """Correlation of time with fare and with tips, over the trips that have rain data."""
    return joined.agg(*_time_corr())


def rain_money_corr(joined: DataFrame) -> DataFrame:
    """Correlation of both rain measures with fare and with tips."""
    return joined.agg(*_rain_corr())


def money_corr(joined: DataFrame) -> DataFrame:
    """The columns of ``time_money_corr`` and ``rain_money_corr`` from one pass."""
    return joined.agg(*_time_corr(), *_rain_corr())
