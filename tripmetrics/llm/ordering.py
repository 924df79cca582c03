"""Running sums over a whole table in a given order, without one task that sees all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmetrics.sources import stage


def running(df: DataFrame, order: dict[str, Column], sums: dict[str, Column], group: str | None = None, label: str = "ranged") -> DataFrame:
    """``df`` with, for each name of ``sums``, the sum over the rows before, in the order given and within ``group``.

    Rows are ranged over tasks by group and order, and the parts written. What lies before a part is a sum over one row
    per part; what lies before a row in its own part is a window over that part alone. So a group with most of the
    rows is many parts. Rows that agree in group and order are next to each other in any order, and in one part.
    Nulls are values like any other and come first. The names of ``order`` and ``_part``, ``_group``, ``_own`` must be
    free in ``df``.
    """
    by = W.partitionBy("_part", "_group").orderBy(*order)
    before = by.rowsBetween(W.unboundedPreceding, -1)
    parts_before = W.partitionBy("_group").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    key = F.struct(F.col(group).alias("g")) if group else F.struct(F.lit(0).alias("g"))
    ranged = df.withColumns({**order, **sums, "_group": key})
    ranged = ranged.repartitionByRange("_group", *order)
    ranged = stage(ranged.withColumn("_part", F.spark_partition_id()), label)
    totals = ranged.groupBy("_group", "_part").agg(*[F.sum(name).alias(name) for name in sums])
    zero = F.lit(0)
    offsets = totals.select(
        "_group", "_part", F.struct(*[F.coalesce(F.sum(n).over(parts_before), zero).alias(n) for n in sums]).alias("_own")
    )
    found = ranged.join(offsets, ["_group", "_part"])
    found = found.withColumns({n: F.coalesce(F.sum(n).over(before), zero) + F.col("_own")[n] for n in sums})
    return found.drop("_group", "_part", "_own", *order)
