"""Pickup counts and clusters."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import tables
from tripmetrics.operators import filters, hotspots


@pytest.fixture(scope="module")
def points(spark, sf_dir):
    return tables.trip_points(spark, sf_dir)


@pytest.fixture(scope="module")
def counts(points):
    return hotspots.pickup_counts(points).cache()


@pytest.fixture(scope="module")
def model(counts):
    return hotspots.fit_clusters(counts, 10)


def test_counts_cover_the_valid_points(points, counts):
    valid = filters.valid_points(points).count()
    assert 0 < valid < points.count()
    assert counts.agg(F.sum("trips")).first()[0] == valid


def test_bounds(points):
    box = hotspots.point_bounds(points).first()
    rows = filters.valid_points(points).collect()
    assert box.min_start_lat == min(r.start_lat for r in rows)
    assert box.max_start_lng == max(r.start_lng for r in rows)


def test_each_point_belongs_to_its_nearest_centre(spark, points, model):
    centers = hotspots.cluster_centers(spark, model).collect()
    assert [c.cluster for c in centers] == list(range(10))
    rows = hotspots.cluster_points(model, points).collect()
    assert len(rows) == filters.valid_points(points).count()
    for r in rows:
        distances = [(r.start_lat - c.lat) ** 2 + (r.start_lng - c.lng) ** 2 for c in centers]
        assert distances[r.cluster] == pytest.approx(min(distances), abs=1e-9)


def test_hotspots_add_up_and_descend(points, counts, model):
    rows = hotspots.cluster_hotspots(model, counts).collect()
    assert sum(r.trips for r in rows) == filters.valid_points(points).count()
    assert [r.trips for r in rows] == sorted((r.trips for r in rows), reverse=True)


def test_weights_stand_for_trips(spark):
    """A centre is the mean of its trips, not of its distinct positions."""
    rows = [(0.0, 0.0)] * 9 + [(1.0, 0.0)] + [(100.0, 100.0)] * 5
    trips = spark.createDataFrame(rows, "start_lat double, start_lng double")
    counts = hotspots.pickup_counts(trips)
    model = hotspots.fit_clusters(counts, 2)
    lats = sorted(r.lat for r in hotspots.cluster_centers(spark, model).collect())
    assert lats == pytest.approx([0.1, 100.0])
    assert hotspots.cluster_silhouette(model, trips).first().silhouette > 0.99


def test_silhouette_against_brute_force(spark, points, model):
    rows = hotspots.cluster_points(model, points).collect()
    where = np.array([(r.start_lat, r.start_lng) for r in rows])
    cluster = np.array([r.cluster for r in rows])
    squared = ((where[:, None, :] - where[None, :, :]) ** 2).sum(axis=2)
    values = []
    for i, own in enumerate(cluster):
        members = cluster == own
        if members.sum() == 1:
            values.append(0.0)
            continue
        inside = squared[i, members].sum() / (members.sum() - 1)
        outside = min(squared[i, cluster == c].mean() for c in set(cluster) - {own})
        values.append((outside - inside) / max(inside, outside))
    assert hotspots.cluster_silhouette(model, points).first().silhouette == pytest.approx(np.mean(values), abs=1e-9)


def brute_silhouette(where, cluster):
    squared = ((where[:, None, :] - where[None, :, :]) ** 2).sum(axis=2)
    values = []
    for i, own in enumerate(cluster):
        members = cluster == own
        inside = squared[i, members].sum() / max(members.sum() - 1, 1)
        outside = min(squared[i, cluster == c].mean() for c in set(cluster) - {own})
        values.append(0.0 if members.sum() == 1 else (outside - inside) / max(inside, outside))
    return np.mean(values)


def test_silhouette_with_heavy_positions_alone_and_far_from_zero(spark):
    """Positions that very many trips share, a trip alone in its cluster, and clusters a few metres wide."""
    r = np.random.default_rng(4)
    rows = [(41.9, -87.6)] * 300 + [(41.90001, -87.60002)] * 7 + [(10.0, 10.0)]
    rows += [(41.8 + x, -87.7 + y) for x, y in r.normal(0, 1e-5, (40, 2)).tolist()]
    trips = spark.createDataFrame(rows, "start_lat double, start_lng double")
    counts = hotspots.pickup_counts(trips)
    model = hotspots.fit_clusters(counts, 3)
    placed = hotspots.cluster_points(model, trips).collect()
    want = brute_silhouette(np.array([(p.start_lat, p.start_lng) for p in placed]), np.array([p.cluster for p in placed]))
    assert len({p.cluster for p in placed}) == 3
    for table in (trips, counts):
        assert hotspots.cluster_silhouette(model, table).first().silhouette == pytest.approx(want, abs=1e-9)


def test_silhouette_needs_two_clusters(spark, model):
    one = spark.createDataFrame([(0.1, 0.1)] * 3, "start_lat double, start_lng double")
    assert hotspots.cluster_silhouette(model, one).first().silhouette is None
    assert hotspots.cluster_silhouette(model, one.limit(0)).first().silhouette is None


def test_silhouette_reads_the_positions_once(spark, counts, model, tmp_path):
    """After the moments of the clusters are known, one pass; the trips aren't read."""
    path = str(tmp_path / "counts")
    counts.write.parquet(path)
    plan = hotspots.cluster_silhouette(model, spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
