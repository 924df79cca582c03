"""Pickup hotspots: counts by position and K-means clusters.

Trip positions are centroids of areas, so many trips share one. Clustering works on the distinct
positions weighted by their number of trips: the same objective as clustering every trip, on a table
that is as small as the number of positions and in which a busy position is one row.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmetrics.operators.filters import valid_points

START = ("start_lat", "start_lng")


def pickup_counts(points: DataFrame) -> DataFrame:
    """Number of trips by pickup position; trips without one are left out."""
    return valid_points(points, START).groupBy(*START).agg(F.count("*").alias("trips"))


def point_bounds(points: DataFrame) -> DataFrame:
    """Bounding box of the pickup positions; takes points or ``pickup_counts``."""
    return valid_points(points, START).agg(
        *[f(c).alias(f"{name}_{c}") for c in START for name, f in (("min", F.min), ("max", F.max))]
    )


def _with_features(points: DataFrame) -> DataFrame:
    assembler = VectorAssembler(inputCols=list(START), outputCol="features", handleInvalid="skip")
    return assembler.transform(points)


def fit_clusters(counts: DataFrame, k: int = 10, seed: int = 1, max_iter: int = 20) -> KMeansModel:
    """Fit K-means to ``pickup_counts``. This runs jobs; the assembled rows are kept only while fitting.

    Pass the counts as a stage table: each job then starts from the small table, also after executors
    are lost, and never from the trips.
    """
    kmeans = KMeans(k=k, seed=seed, maxIter=max_iter, weightCol="trips", predictionCol="cluster")
    return kmeans.fit(_with_features(counts).select("features", "trips"))


def cluster_points(model: KMeansModel, points: DataFrame) -> DataFrame:
    """The cluster of every trip with a known pickup position; a map over the rows, no shuffle."""
    return model.transform(_with_features(valid_points(points, START))).drop("features")


def cluster_centers(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """The ``k`` cluster centres."""
    rows = [(i, float(lat), float(lng)) for i, (lat, lng) in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster int, lat double, lng double")


def cluster_hotspots(model: KMeansModel, counts: DataFrame) -> DataFrame:
    """Number of trips by cluster and position, busiest first."""
    return (
        cluster_points(model, counts)
        .select("cluster", *START, "trips")
        .orderBy(F.desc("trips"), "cluster", *START)
    )


def cluster_silhouette(model: KMeansModel, points: DataFrame) -> DataFrame:
    """Mean silhouette (squared Euclidean) of all trips as one row. Takes ``pickup_counts`` or the trips' points.

    The mean squared distance from a position to the trips of a cluster is its squared distance to their mean plus
    their variance. So a cluster is known by its number of trips, its mean and its variance, one aggregate gives these,
    and a second pass over the positions the silhouettes. In its own cluster a trip is left out of the trips that it is
    compared with, and the others at its position are not. Sums are taken from the centres, so that they stay small.

    A trip alone in its cluster has silhouette 0. NULL where fewer than two clusters are in use: a silhouette compares
    two. Runs a job for one row a cluster; pass the counts as a stage and the trips are not read.
    """
    counts = points if "trips" in points.columns else pickup_counts(points)
    placed = model.transform(_with_features(valid_points(counts, START))).select("cluster", *START, "trips")
    centres = [tuple(map(float, c)) for c in model.clusterCenters()]
    at = F.get(F.array(*[F.array(F.lit(lat), F.lit(lng)) for lat, lng in centres]), F.col("cluster"))
    off = [F.col(c) - at[i] for i, c in enumerate(START)]
    sums = placed.groupBy("cluster").agg(
        F.sum("trips"), *[F.sum(F.col("trips") * o) for o in off], F.sum(F.col("trips") * (off[0] * off[0] + off[1] * off[1]))
    )
    moments = []
    for cluster, n, *shift, squares in sums.collect():
        shift = [s / n for s in shift]
        mean = [c + s for c, s in zip(centres[cluster], shift)]
        moments.append((cluster, n, *mean, max(0.0, squares / n - shift[0] ** 2 - shift[1] ** 2)))
    if len(moments) < 2:
        return points.sparkSession.createDataFrame([(None,)], "silhouette double")

    names = ("of", "n", *START, "spread")
    known = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in moments])
    far = lambda m: sum((F.col(c) - m[c]) * (F.col(c) - m[c]) for c in START) + m["spread"]
    outside = F.array_min(F.transform(known, lambda m: F.when(m["of"] != F.col("cluster"), far(m))))
    own = F.filter(known, lambda m: m["of"] == F.col("cluster"))[0]
    n = own["n"].cast("double")
    inside = far(own) * n / F.nullif(n - 1, F.lit(0.0))
    valued = placed.select("trips", outside.alias("outside"), inside.alias("inside"))
    most = F.nullif(F.greatest("outside", "inside"), F.lit(0.0))
    value = F.when(F.col("inside").isNull(), F.lit(0.0)).otherwise(
        F.coalesce((F.col("outside") - F.col("inside")) / most, F.lit(0.0))
    )
    return valued.agg((F.sum(F.col("trips") * value) / F.sum("trips")).alias("silhouette"))


def can_cluster(counts: DataFrame) -> bool:
    """Whether ``pickup_counts`` has the two positions that fitting needs at least."""
    return counts.limit(2).count() > 1


def no_clusters(counts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The tables of centres, hotspots and silhouette where nothing can be fitted: typed and empty."""
    spark = counts.sparkSession
    hotspots = counts.limit(0).select(F.lit(0).alias("cluster"), *START, "trips")
    centres = spark.createDataFrame([], "cluster int, lat double, lng double")
    return centres, hotspots, spark.createDataFrame([], "silhouette double")
