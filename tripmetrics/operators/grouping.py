"""Grouping that leaves out rows without a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_known(df: DataFrame, keys: list[str], known: str, *aggregates: Column) -> DataFrame:
    """Group by ``keys`` and drop the groups in which ``known``, one of the keys, is NULL.

    The NULL group is dropped by its count. A filter on the key would be pushed below the aggregate and
    into the scan's filter, where a key that is parsed from text is parsed a second time for every row.
    """
    rows = f"known_{known}"
    grouped = df.groupBy(*keys).agg(*aggregates, F.count(known).alias(rows))
    return grouped.filter(F.col(rows) > 0).drop(rows)
