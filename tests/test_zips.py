"""Nearest postcodes against brute force, and postcode pairs."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tripmetrics.operators import zips as z


def miles(a, b):
    (lat_a, lng_a), (lat_b, lng_b) = a, b
    half_lat = math.sin((math.radians(lat_b) - math.radians(lat_a)) / 2)
    half_lng = math.sin((math.radians(lng_b) - math.radians(lng_a)) / 2)
    chord = half_lat**2 + math.cos(math.radians(lat_a)) * math.cos(math.radians(lat_b)) * half_lng**2
    return 2 * 3958.8 * math.asin(min(1.0, math.sqrt(chord)))


def uniform(rng, n):
    return [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(n)]


def around(rng, n, lat, lng, spread):
    return [(lat + rng.gauss(0, spread), lng + rng.gauss(0, spread)) for _ in range(n)]


def wrap(lng):
    return (lng + 180) % 360 - 180


def case(name):
    rng = random.Random(name)
    if name == "whole globe":
        return uniform(rng, 60), uniform(rng, 150)
    if name == "dense town beside empty country":
        town = around(rng, 150, 41.88, -87.63, 0.0005)
        return around(rng, 40, 41.88, -87.63, 0.5) + uniform(rng, 20), town + around(rng, 30, 41.9, -87.6, 3.0)
    if name == "one postcode position for a third":
        return around(rng, 30, 10.0, 10.0, 1.0), [(10.0, 10.0)] * 50 + around(rng, 100, 10.0, 10.0, 1.0)
    if name == "date line":
        both = [[(a, wrap(b)) for a, b in around(rng, n, 0.0, 180.0, 0.3)] for n in (40, 100)]
        return both[0], both[1]
    if name == "pole":
        return [[(rng.uniform(88, 90), rng.uniform(-180, 180)) for _ in range(n)] for n in (40, 100)]
    if name == "positions are postcodes":
        positions = around(rng, 80, 41.88, -87.63, 0.1)
        return positions, positions
    if name == "fewer postcodes than asked for":
        return uniform(rng, 10), uniform(rng, 3)
    if name == "very close together":
        return around(rng, 30, 41.88, -87.63, 1e-6), around(rng, 60, 41.88, -87.63, 1e-6)
    raise KeyError(name)


CASES = (
    "whole globe",
    "dense town beside empty country",
    "one postcode position for a third",
    "date line",
    "pole",
    "positions are postcodes",
    "fewer postcodes than asked for",
    "very close together",
)


def frames(spark, positions, postcodes):
    points = spark.createDataFrame(positions + [(None, 1.0), (1.0, None)], "lat double, lng double")
    reference = [(60000 + i, lat, lng) for i, (lat, lng) in enumerate(postcodes)]
    # Copies of rows must not change the answer.
    rows = reference + reference[:20] + [(1, None, None)]
    return points.union(points), spark.createDataFrame(rows, "zip int, lat double, lng double"), reference


def brute_force(positions, reference, k, max_miles=None):
    expected = {}
    for position in set(positions):
        ranked = sorted((miles(position, (lat, lng)), number) for number, lat, lng in reference)
        if max_miles is not None:
            ranked = [r for r in ranked if r[0] <= max_miles]
        expected[position] = ranked[:k]
    return expected


def check(result, expected, reference):
    where = {number: (lat, lng) for number, lat, lng in reference}
    got = {}
    for r in result.orderBy("lat", "lng", "place").collect():
        got.setdefault((r.lat, r.lng), []).append((r.miles, r.zip))
    assert set(got) == {p for p, ranked in expected.items() if ranked}
    for position, ranked in got.items():
        want = expected[position]
        assert len(ranked) == len(want)
        assert [m for m, _ in ranked] == pytest.approx([m for m, _ in want], abs=1e-7)
        assert len({number for _, number in ranked}) == len(ranked)
        for (m, number), (_, wanted) in zip(ranked, want):
            same_place = where[number] == where[wanted]
            assert number == wanted or (not same_place and abs(miles(position, where[number]) - m) < 1e-7)


@pytest.mark.parametrize("name", CASES)
def test_nearest_zips_against_brute_force(spark, name):
    positions, postcodes = case(name)
    points, zips, reference = frames(spark, positions, postcodes)
    check(z.nearest_zips(points, zips), brute_force(positions, reference, 5), reference)


@pytest.mark.parametrize("limit", [0.0, 20.0, 3000.0])
def test_nearest_zips_within_a_distance(spark, limit):
    positions, postcodes = case("dense town beside empty country")
    points, zips, reference = frames(spark, positions, postcodes)
    expected = brute_force(positions, reference, 3, limit)
    check(z.nearest_zips(points, zips, k=3, max_miles=limit), expected, reference)


def ring(rng, n, width):
    angles = [rng.uniform(0, 2 * math.pi) for _ in range(n)]
    return [(41.88 + width * math.sin(a), -87.63 + width * math.cos(a)) for a in angles]


@pytest.mark.parametrize("postcodes", [5_000, 50_000])
@pytest.mark.parametrize("where", ["ring 0.02", "ring 0.1", "ring 0.3", "town only", "west of a border", "inside"])
def test_search_reads_few_postcodes(spark, where, postcodes):
    """Candidates follow k, wherever positions lie and however many postcodes there are."""
    rng = random.Random(where)
    town = around(rng, postcodes, 41.88, -87.63, 0.005)
    if where == "inside":
        positions, zips = around(rng, 500, 41.88, -87.63, 0.005), town
    elif where == "west of a border":
        positions = [(rng.uniform(41, 42), -90 - rng.uniform(0.001, 0.01)) for _ in range(500)]
        zips = [(rng.uniform(41, 42), -90 + rng.uniform(0.001, 1)) for _ in range(postcodes)]
    else:
        positions = ring(rng, 500, 0.1 if where == "town only" else float(where.split()[1]))
        zips = town if where == "town only" else town + around(rng, 200, 41.88, -87.63, 2.0)
    points = z._on_sphere(spark.createDataFrame(positions, "lat double, lng double"))
    reference = spark.createDataFrame([(i, *p) for i, p in enumerate(zips)], "zip int, lat double, lng double")
    tree, _ = z.cell_tree(reference, 5)
    read = z.leaves_in_reach(points, tree, 5).agg(F.sum("count")).first()[0]
    assert read <= 200 * len(positions)


def test_pairs_of_the_documented_example(spark):
    starts = [60640, 60660, 60613, 60657, 60625]
    ends = [60660, 60640, 60626, 60659, 60645]
    df = spark.createDataFrame([(starts, ends)], "s array<int>, e array<int>")
    pairs = df.select(z.sorted_pairs(F.col("s"), F.col("e"))).first()[0]
    assert [tuple(p) for p in pairs] == [(60613, 60626), (60625, 60645), (60640, 60660), (60657, 60659)]


def test_pairs_stop_at_the_shorter_side(spark):
    df = spark.createDataFrame([([2, 1, 9], [1, 2]), ([], [1])], "s array<int>, e array<int>")
    rows = [[tuple(p) for p in r[0]] for r in df.select(z.sorted_pairs(F.col("s"), F.col("e"))).collect()]
    assert rows == [[(1, 2)], []]


def test_zip_pairs_by_trip(spark):
    trips = spark.createDataFrame(
        [(1, 0.0, 0.0, 1.0, 1.0), (2, 1.0, 1.0, 0.0, 0.0), (3, None, None, 1.0, 1.0)],
        "trip_id int, start_lat double, start_lng double, end_lat double, end_lng double",
    )
    zips = spark.createDataFrame([(10, 0.0, 0.0), (11, 1.0, 1.0)], "zip int, lat double, lng double")
    nearest = z.nearest_zips(z.trip_ends(trips), zips, k=1)
    rows = z.zip_pairs(trips, z.zip_lists(nearest)).orderBy("trip_id").collect()
    assert [(r.trip_id, [tuple(p) for p in r.zip_pairs]) for r in rows] == [(1, [(10, 11)]), (2, [(10, 11)])]
