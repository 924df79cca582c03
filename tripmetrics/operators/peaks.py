"""The row with the highest value, for several metrics in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def peak_rows(df: DataFrame, key: str, metrics: tuple[str, ...]) -> DataFrame:
    """One row per metric: the whole row of ``df`` in which that metric is highest.

    Equal values go to the smallest key. All metrics are found by one aggregate, so ``df`` is computed
    once and only one candidate row per task and metric is shuffled.
    """
    row = F.struct(*df.columns)

    def best(metric: str):
        order = F.when(F.col(metric).isNotNull(), F.struct(-F.col(metric), F.col(key)))
        return F.min_by(row, order).alias(metric)

    found = df.agg(*[best(m) for m in metrics])
    rows = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), *[F.col(m)[c].alias(c) for c in df.columns])
            for m in metrics
        ]
    )
    return found.select(F.inline(rows)).filter(F.col(key).isNotNull())
