"""Nearest postcodes of trip ends, and the pairs of postcodes of a trip.

The search is exact and descends a tree of grid cells instead of comparing every position with every postcode.

Positions become points on the unit sphere, and a cube around the sphere is cut into cells: level 0 is the whole
cube, each level halves the side. On the sphere there is no date line and no pole to treat, and straight-line
distance orders points as great-circle distance does. Every second level is used. A cell of at most ``LEAF``
postcodes is a leaf, and only cells with more are cut further, so the tree is deep where postcodes are dense.
Each cell is kept with its number of postcodes and the box that they fill.

Every position goes down the tree with a set of cells, at first the whole cube. A step puts a cell's occupied parts
in its place. The smallest distance at which the far corners of boxes add up to ``k`` postcodes bounds the answer,
and cells whose nearest corner is beyond it are dropped. Postcodes are joined at the leaves that are left.

The bound follows the boxes and not the cells' borders, so neither a dense area beside the position nor a border of
the grid through it makes the search wide. Nothing caps the set of cells: what is dropped can't hold an answer.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmetrics import functions as tm
from tripmetrics.functions.geo import EARTH_RADIUS_MILES
from tripmetrics.sources import stage

# Cells of level 20 are about 12 metres wide; cell numbers then stay below 2 ** 61.
LEVELS = range(0, 21, 2)
LEAF = 8
# A little more than the sphere's diameter, so that a coordinate of exactly 1 is inside the cube.
CUBE_SIDE = 2.002
# Distances are compared after different roundings; the slack is far above those and far below a metre.
ROUNDING_SLACK = 1e-9
ROOT_CELL = 1
# Parts of the cube that every position meets at first; a step leads to no more than this from one cell.
FIRST_PARTS = 4**3

# A cell's number. Those of a level with n cells per axis lie between n ** 3 and 2 * n ** 3, so cells of
# different levels never share a number.
CELL_NUMBER = "((n + {ix}) * n + {iy}) * n + {iz}"


def _on_sphere(df: DataFrame) -> DataFrame:
    """Add the unit-sphere point of (lat, lng), scaled to [0, 1) in the cube."""
    return df.selectExpr(
        "*",
        f"(cos(radians(lat)) * cos(radians(lng)) + 1) / {CUBE_SIDE}D AS x",
        f"(cos(radians(lat)) * sin(radians(lng)) + 1) / {CUBE_SIDE}D AS y",
        f"(sin(radians(lat)) + 1) / {CUBE_SIDE}D AS z",
    )


def _first_zips_per_position(zips: DataFrame, k: int) -> DataFrame:
    """Postcodes that can be in an answer: of those at one position, the ``k`` smallest.

    Postcodes at one position are equally far from everywhere and ties go to the smaller postcode, so
    the others can never be among the first ``k``.
    """
    distinct = zips.select("zip", "lat", "lng").na.drop().distinct()
    smallest = Window.partitionBy("lat", "lng").orderBy("zip")
    return distinct.withColumn("place", F.row_number().over(smallest)).filter(F.col("place") <= k).drop("place")


def _at_all_levels(points: DataFrame) -> DataFrame:
    """One row per level, with the cell at that level and the cell around it at the level above."""
    levels = ", ".join(f"{level}" for level in LEVELS)
    own = CELL_NUMBER.format(ix="floor(x * n)", iy="floor(y * n)", iz="floor(z * n)")
    return (
        points.selectExpr("*", f"explode(array({levels})) AS level")
        .selectExpr("*", "shiftleft(1L, level) AS n")
        .selectExpr("*", f"{own} AS cell")
        .selectExpr("* EXCEPT (n)", f"shiftleft(1L, greatest(level - {LEVELS.step}, 0)) AS n")
        .selectExpr("* EXCEPT (n)", f"if(level = 0, NULL, {own}) AS parent")
    )


def cell_tree(zips: DataFrame, k: int, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The steps of the tree, and the postcodes with their leaves. This runs jobs: both are staged.

    A step leads from ``parent`` to ``cell``, with the cell's count, box, level and whether it is a ``leaf``.
    Leaves lead to themselves as well, so that one join moves every cell of a set on.
    """
    rows = _at_all_levels(_on_sphere(_first_zips_per_position(zips, k)))
    box = [f(axis).alias(f"{name}_{axis}") for axis in "xyz" for name, f in (("low", F.min), ("high", F.max))]
    cells = rows.groupBy("cell", "parent", "level").agg(F.count("*").alias("count"), *box)
    # Each cell is small and used several times; the planner sees the real size of a stage.
    cells = stage(cells, "zip-cells", folder)
    large = cells.filter(f"count > {LEAF}").select(F.col("cell").alias("parent"))
    leaf = (F.col("count") <= LEAF) | (F.col("level") == LEVELS[-1])
    steps = cells.join(large, "parent", "left_semi").withColumn("leaf", leaf)
    root = cells.filter("level = 0").withColumn("leaf", leaf)
    ends = steps.unionByName(root).filter("leaf").withColumn("parent", F.col("cell"))
    tree = stage(steps.unionByName(ends), "zip-tree", folder)
    leaves = tree.filter("leaf").select("cell").distinct()
    placed = rows.join(leaves, "cell", "left_semi")
    return tree, stage(
        placed.select("cell", "zip", F.col("lat").alias("zip_lat"), F.col("lng").alias("zip_lng")), "zip-leaves", folder
    )


def _square(expression: str) -> str:
    return f"({expression}) * ({expression})"


def _distances(axis_distance: str) -> str:
    return " + ".join(_square(axis_distance.format(a=a)) for a in "xyz")


def _first_parts(tree: DataFrame) -> tuple[int, int, DataFrame]:
    """The level that the search starts on, the deepest level, and the cells that every position meets first.

    Postcodes of one country lie in few cells of the upper levels. All levels down to the last one on which there are at
    most ``FIRST_PARTS`` cells, leaves above it included, are one step.
    """
    counts = tree.filter("parent <> cell").groupBy("level").agg(F.count("*").alias("n"), F.count_if("leaf").alias("leaves"))
    levels = sorted(tuple(r) for r in counts.collect())
    if not levels:
        return 0, 0, F.broadcast(tree.filter(F.col("parent") == ROOT_CELL))
    start, above = levels[0][0], 0
    for level, n, leaves in levels:
        if n + above <= FIRST_PARTS:
            start = level
        above += leaves
    parts = tree.filter("parent <> cell").filter((F.col("level") == start) | (F.col("leaf") & (F.col("level") < start)))
    # The number of the whole cube, written as positions have it: a constant would leave the join without a key.
    return start, levels[-1][0], F.broadcast(parts.withColumn("parent", F.expr(f"cast(floor(low_x) AS bigint) + {ROOT_CELL}")))


def leaves_in_reach(points: DataFrame, tree: DataFrame, k: int, max_miles: float | None = None) -> DataFrame:
    """The leaves that can hold one of the ``k`` nearest postcodes of a position, with their counts.

    Distances are squares of straight lines in units of the cube's side. All steps of a position stay in one
    window partition; only where the tree is too large to broadcast are cells shuffled to it.
    """
    start, deepest, parts = _first_parts(tree)
    position = ["lat", "lng", "x", "y", "z"]
    # Everything lies in the whole cube, cell 1. Written as its cell, so that the first join has a key as well.
    frontier = points.selectExpr(*position, f"cast(floor(x) AS bigint) + {ROOT_CELL} AS at")
    farthest = None
    if max_miles is not None:
        straight = 2 * math.sin(min(max_miles / EARTH_RADIUS_MILES, math.pi) / 2) / CUBE_SIDE
        farthest = straight * straight * (1 + ROUNDING_SLACK) + ROUNDING_SLACK**2
    of_position = Window.partitionBy("lat", "lng")
    by_far = of_position.orderBy("far", "cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for level in range(start, max(start, deepest) + 1, LEVELS.step):
        onward = parts if level == start else tree
        moved = frontier.drop("held").join(onward, F.col("at") == F.col("parent")).selectExpr(
            *position,
            "cell",
            "count",
            f"{_distances('greatest(low_{a} - {a}, {a} - high_{a}, 0D)')} AS near",
            f"{_distances('greatest({a} - low_{a}, high_{a} - {a})')} AS far",
        )
        enough = F.when(F.sum("count").over(by_far) >= k, F.col("far"))
        bounded = moved.withColumn("enough", enough).withColumn("bound", F.min("enough").over(of_position))
        kept = F.col("bound").isNull() | (F.col("near") <= F.col("bound") * (1 + ROUNDING_SLACK) + ROUNDING_SLACK**2)
        if farthest is not None:
            kept &= F.col("near") <= farthest
        frontier = bounded.filter(kept).select(*position, F.col("cell").alias("at"), F.col("count").alias("held"))
    return frontier.select("lat", "lng", F.col("at").alias("cell"), F.col("held").alias("count"))


def _miles_to_zip() -> Column:
    return tm.haversine_miles(F.col("lat"), F.col("lng"), F.col("zip_lat"), F.col("zip_lng"))


def trip_ends(trips: DataFrame) -> DataFrame:
    """The distinct positions at which trips start or end."""
    ends = F.inline(
        F.array(*[F.struct(F.col(f"{e}_lat").alias("lat"), F.col(f"{e}_lng").alias("lng")) for e in ("start", "end")])
    )
    return trips.select(ends).na.drop().distinct()


def nearest_zips(
    points: DataFrame, zips: DataFrame, k: int = 5, max_miles: float | None = None, folder: str | None = None
) -> DataFrame:
    """The ``k`` nearest postcodes of each distinct position (lat, lng), nearest first.

    Equal distances go to the smaller postcode. With ``max_miles`` farther postcodes do not count, and a
    position may get fewer than ``k``.

    This runs jobs: the postcodes' cells are staged. They are used at every step, and the planner cannot
    estimate how many rows come of putting each postcode into a cell per level, so it would choose
    broadcasts by a size that is far too small. A stage has a known size.
    """
    positions = _on_sphere(points.select("lat", "lng").na.drop().distinct())
    tree, leaves = cell_tree(zips, k, folder)
    searched = leaves_in_reach(positions, tree, k, max_miles)
    candidates = searched.join(leaves, "cell").withColumn("miles", _miles_to_zip())
    if max_miles is not None:
        candidates = candidates.filter(F.col("miles") <= float(max_miles))
    nearest_first = Window.partitionBy("lat", "lng").orderBy("miles", "zip")
    placed = candidates.select("lat", "lng", "zip", "miles").withColumn("place", F.row_number().over(nearest_first))
    return placed.filter(F.col("place") <= k)


def sorted_pairs(starts: Column, ends: Column) -> Column:
    """Pair the i-th start with the i-th end, smaller postcode first, each pair once, in order.

    The longer side's rest has no partner and is left out.
    """
    shorter = F.least(F.size(starts), F.size(ends))
    ordered = F.zip_with(
        F.slice(starts, F.lit(1), shorter),
        F.slice(ends, F.lit(1), shorter),
        lambda a, b: F.struct(
            F.least(a, b).cast("int").alias("zip_a"), F.greatest(a, b).cast("int").alias("zip_b")
        ),
    )
    return F.array_sort(F.array_distinct(ordered))


def zip_lists(nearest: DataFrame) -> DataFrame:
    """The result of ``nearest_zips`` as one row per position: its postcodes, nearest first."""
    return nearest.groupBy("lat", "lng").agg(
        F.array_sort(F.collect_list(F.struct("place", "zip")))["zip"].alias("zips")
    )


def zip_pairs(trips: DataFrame, lists: DataFrame) -> DataFrame:
    """Pairs of postcodes near the start and the end of each trip that has both positions.

    ``lists`` is ``zip_lists`` of the trips' ends. Both joins look up one row per position. Pass it as a
    stage table: it is read twice, and while it is small the planner broadcasts it, so trips are not
    shuffled. Above the broadcast limit the join is a sort-merge join in which adaptive execution splits
    positions that hold many trips.
    """

    def ends(which: str) -> DataFrame:
        return lists.select(*[F.col(c).alias(f"{which}_{c}") for c in ("lat", "lng", "zips")])

    joined = trips.join(ends("start"), ["start_lat", "start_lng"]).join(ends("end"), ["end_lat", "end_lng"])
    return joined.select("trip_id", sorted_pairs(F.col("start_zips"), F.col("end_zips")).alias("zip_pairs"))
