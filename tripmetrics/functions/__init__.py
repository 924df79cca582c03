"""Column functions. All of them are compositions of Spark's built-in functions."""

from tripmetrics.functions.columns import (
    DIGESTS,
    TIMESTAMP_FORMAT,
    correlation,
    digest_number,
    epoch_seconds,
    finite,
    midpoint_hour,
    month_name,
    or_zero,
    parse_time,
    revenue,
    share_pct,
    speed_mph,
    squeeze_spaces,
    tip_pct,
    tip_per_mile,
    truncate_time,
    year_one,
)
from tripmetrics.functions.geo import haversine_miles

__all__ = [
    "DIGESTS",
    "TIMESTAMP_FORMAT",
    "correlation",
    "digest_number",
    "epoch_seconds",
    "finite",
    "haversine_miles",
    "midpoint_hour",
    "month_name",
    "or_zero",
    "parse_time",
    "revenue",
    "share_pct",
    "speed_mph",
    "squeeze_spaces",
    "tip_pct",
    "tip_per_mile",
    "truncate_time",
    "year_one",
]
