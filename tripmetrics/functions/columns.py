"""Scalar rules for trips and weather, and the guarded correlation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the time format of both CSV sources.
TIMESTAMP_FORMAT = "MM/dd/yyyy hh:mm:ss a"


# Whole units below a day. Larger units are cut on the date.
_SMALL_UNITS = ("second", "minute", "hour")
# Times are counted from the year 1, so that none is negative: counts are cut towards zero.
_SECONDS_TO_1970 = 62_135_596_800


def or_zero(number: Column) -> Column:
    """A missing number counts as 0 (sums, means and filters all see it)."""
    return F.coalesce(number, F.lit(0))


def finite(number: Column) -> Column:
    """NaN and infinities as NULL: they are texts that CSV readers accept as numbers, not measurements."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def parse_time(text: Column) -> Column:
    """12-hour text to a zone-less timestamp; NULL for NULL and for text that is no such time.

    The text is read with an explicit zone and rebuilt from its seconds, so the session's zone, and hours that
    it skips or repeats, don't matter.
    """
    instant = F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(f"{TIMESTAMP_FORMAT} Z"))
    return _epoch() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.unix_seconds(instant).cast("decimal(18, 6)"))


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def truncate_time(ts: Column, unit: str | None) -> Column:
    """The time cut down to a whole ``unit`` such as ``'hour'``; unchanged without a unit.

    The time is named once, so one that comes from text is parsed once wherever the result is used.
    """
    if unit is None:
        return ts
    if unit not in _SMALL_UNITS:
        return F.trunc(ts.cast("date"), unit).cast("timestamp_ntz") if unit != "day" else ts.cast("date").cast("timestamp_ntz")
    passed = ts - year_one()
    if unit != "second":
        return year_one() + passed.cast(f"interval day to {unit}")
    seconds = passed.cast("interval second").cast("bigint").cast("decimal(18, 6)")
    return year_one() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def year_one() -> Column:
    """The time from which times are counted, without a zone."""
    return F.expr("TIMESTAMP_NTZ'0001-01-01 00:00:00'")


def speed_mph(miles: Column, seconds: Column) -> Column:
    """Average speed; 0 for a trip without duration."""
    return F.when(seconds == 0, F.lit(0.0)).otherwise(miles / seconds * 3600)


def midpoint_hour(start: Column, end: Column) -> Column:
    """Hour of day half-way between start and end."""
    return F.hour(start + (end - start) / 2)


def revenue(fare: Column, tips: Column) -> Column:
    """What the driver earns on a trip, tolls and extras left out."""
    return fare + tips


def tip_pct(tips: Column, fare: Column) -> Column:
    """Tip as a percentage of the fare; 0 where there is no fare."""
    return F.when(fare == 0, F.lit(0.0)).otherwise(tips / fare * 100)


def tip_per_mile(tips: Column, miles: Column) -> Column:
    """Tip per mile; the whole tip where no distance was recorded."""
    return F.when(miles == 0, tips).otherwise(tips / miles)


def month_name(ts: Column) -> Column:
    """Full English month name. Of the date: a time would be read in the session's zone."""
    return F.date_format(ts.cast("date"), "MMMM")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970-01-01, the time read as UTC. The time is named once (see ``truncate_time``)."""
    return (ts - year_one()).cast("interval second").cast("bigint") - _SECONDS_TO_1970


# Digest numbers lie below this.
DIGESTS = 1 << 32


def digest_number(seed: int, *columns: str) -> Column:
    """The first 32 bits of the MD5 of a seed and of values, as a number: alike for equal rows wherever they are."""
    values = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.conv(F.left(F.md5(F.concat(F.lit(str(seed)), *values)), F.lit(8)), 16, 10).cast("bigint")


def squeeze_spaces(text: Column) -> Column:
    """Text with its spaces removed; NULL stays NULL."""
    return F.replace(text, F.lit(" "), F.lit(""))


def share_pct(part: Column, whole: Column) -> Column:
    """Percentage of ``part`` in ``whole``; 0 where the whole is 0."""
    return F.coalesce(part / F.nullif(whole, F.lit(0)) * 100, F.lit(0.0))


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation of the rows that have both; NULL where a side is constant or fewer than two rows count.

    ``corr`` raises a division error on a constant side in ANSI mode. Constancy is decided by the extremes: merged
    deviations of a constant can differ from 0 in their last bits, by how rows are spread over tasks.
    """
    a, b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    constant = (F.min(a) == F.max(a)) | (F.min(b) == F.max(b))
    spread = F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))
    return F.when(~constant, F.covar_pop(a, b) / spread)
