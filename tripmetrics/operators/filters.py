"""Filters and samples."""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics import functions as tm


@dataclass(frozen=True)
class QualityRules:
    """Limits of a good trip; a value exactly on a limit is good."""

    min_seconds: int = 60
    max_mph: float = 100.0
    max_miles: float = 1000.0
    max_fare: float = 2000.0

    def is_good(self) -> Column:
        return (
            (F.col("trip_seconds") >= self.min_seconds)
            & (F.col("trip_miles") <= self.max_miles)
            & (F.col("fare") <= self.max_fare)
            & (F.col("speed_mph") <= self.max_mph)
        )


def good_trips(trips: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Trips that pass the quality rules. All limits reach the scan of a typed stage table."""
    return trips.filter(rules.is_good())


def year_slice(trips: DataFrame, year: int, staged: bool = True) -> DataFrame:
    """Trips that start in one year.

    On a typed table the slice is also a time range; a stage that is partitioned by ``year`` is pruned to one folder. With ``staged=False``, for times that are still parsed from
    text, only the year is compared, so that the filter parses each text once.
    """
    # Compared with a value for an unknown year, or a test for NULL would parse the text once more.
    in_year = F.coalesce("year", F.lit(0)) == year
    if staged:
        in_year = F.col("year") == year
        first, following = (F.lit(f"{y:04d}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
        in_year &= (F.col("start_ts") >= first) & (F.col("start_ts") < following)
    return trips.filter(in_year)


def taxi_slice(trips: DataFrame, taxi_id: str | int) -> DataFrame:
    """All trips of one taxi."""
    return trips.filter(F.col("taxi_id") == F.lit(taxi_id))


def valid_points(points: DataFrame, columns: tuple[str, ...] = ("start_lat", "start_lng")) -> DataFrame:
    """Rows whose position is known."""
    return points.na.drop(subset=list(columns))


def sample_trips(
    trips: DataFrame, fraction: float = 0.0001, seed: int = 81, key: tuple[str, ...] = ("trip_id",)
) -> DataFrame:
    """Seeded sample without replacement; ``fraction`` is the chance of each row.

    A row is in by the digest of its key, not by its place in a file: the same rows are in however the table is
    written or split, in any engine that has MD5, and also in tables joined on the key. Rows with equal keys
    share their chance, so give more columns where ids are missing.
    """
    return trips.filter(tm.digest_number(seed, *key) < math.floor(fraction * tm.DIGESTS))


def poisson_limits(mean: float) -> list[int]:
    """Digest numbers from which on a row has one copy more: the Poisson distribution, turned round."""
    if not 0 <= mean <= 100:
        raise ValueError("a row can be expected 0 to 100 times")
    limits, copies, chance = [], 0, math.exp(-mean)
    below = chance
    while copies <= mean or chance * tm.DIGESTS >= 1:
        limits.append(math.floor(below * tm.DIGESTS))
        copies += 1
        chance *= mean / copies
        below += chance
    return limits


def bootstrap_points(
    points: DataFrame, fraction: float = 0.1, seed: int = 81, key: tuple[str, ...] = ("trip_id",)
) -> DataFrame:
    """Seeded sample with replacement; ``fraction`` is the expected number of copies of each row.

    Copies follow a Poisson distribution, as in a bootstrap of a table of unknown size, by the digest of the row's
    key (see ``sample_trips``). A map over the rows, no shuffle.
    """
    numbered = points.select(F.struct("*").alias("row"), tm.digest_number(seed, *key).alias("number"))
    limits = [(F.col("number") >= limit).cast("int") for limit in poisson_limits(fraction)]
    copies = functools.reduce(Column.__add__, limits)
    again = numbered.select("row", F.explode(F.array_repeat(F.lit(0), copies)))
    return again.select(*[F.col(f"row.`{n}`") for n in points.columns])
