"""Connected components by alternating stars, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.sources import Stages


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One round. Large: what is above a node moves to the least node beside it. Small: what is below does.

    The least neighbour is an aggregate that combines on the map side, and joins back to the edges, so a node
    with very many edges is never gathered.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        moved = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
    else:
        least = edges.groupBy("b").agg(F.min("a").alias("m"))
        below = edges.join(least, "b").select("m", F.col("a").alias("x"))
        moved = below.select(F.col("m").alias("a"), F.col("x").alias("b")).unionByName(
            least.select(F.col("m").alias("a"), "b")
        )
    return moved.where("a < b").distinct()


# Links in a written part, about. Rounds work on what is left, so most of them need few parts.
PART_LINKS = 200_000


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def components(edges: DataFrame, into: Stages | None = None) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of ``edges`` (``a``, ``b``).

    Loops, repeated links and their direction don't matter; links with a null end are left out. Nodes that are
    their own root are left out as well: whoever is not in the result is the root of its component. A chain of
    n nodes takes in the order of log(n) rounds. A round is removed when the next one is written; the last one is a
    stage of ``into``, or stays in a folder of its own.
    """
    own = into or Stages(edges.sparkSession, "components")
    links = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    name, number = "components-0", 0
    links = own.write(links, name)
    mark = _mark(links)
    while mark[0]:
        # Written in as many parts as so many links need.
        number, parts = number + 1, mark[0] // PART_LINKS + 1
        links = own.write(_stars(links, True).coalesce(parts), f"components-{number}-large", done=(name,))
        large, name = f"components-{number}-large", f"components-{number}"
        links = own.write(_stars(links, False).coalesce(parts), name, done=(large,))
        before, mark = mark, _mark(links)
        if before == mark:
            break
    return links.select(F.col("b").alias("node"), F.col("a").alias("root"))
