"""Mixing sources to target weights by systematic sampling. Built-in functions only.

A document's size is its number of words. The sources in the order of their code points, null last, weigh 5, 2, 1, 5,
2, 1 and so on, and share the size of the whole table by weight. A source's target stops at ``MOST`` times its own
size, and what is over is shared by weight again until no target is above. That is a water level: sources in the order
of ``MOST * size / weight`` are full up to some place, and the rest get one level times their weight. Two running sums
over the sources find that place at once.

Within its source every document is expected the same number of copies, target over source size. Documents go by size,
the largest first; the prefix sum of expected copies, plus one random offset of the source, crosses whole numbers, and
a document is emitted once for each crossed inside its own interval. Prefix sums are off by less than one
copy at any place, so with sizes that only fall the words taken are off by less than the largest document of the source.

Numbers are exact: copies are counted in ``1 / UNIT``, and offsets come from a digest of the seed and the source's name,
so the same table gives the same mix with any number of tasks.

Scale: sizes, not texts, are ranged over tasks, and a source with most of the documents is split over many
(``ordering.running``). Sources are a table and are never collected; the driver sees sums of them.

Results for odd input: a null or empty text has size 0 and takes 0, with any number of copies. A null source is a
source. A source without words has target 0. Repeated rows are rows of their own and each have an interval; ties of
size go by document id, null first. An empty table gives no rows. Of other columns, those named like an added one give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.ordering import running
from tripmetrics.sources import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
# A source is taken this many times at most.
MOST = 3
# Copies are counted in parts of this size.
UNIT = 1 << 32
SEED = "mix"


def size_of(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def offset_of(source: Column, seed: str = SEED) -> Column:
    """A number under ``UNIT`` for every source."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.left(F.md5(named), F.lit(8)), 16, 10).cast("bigint")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """``source``, ``source_size``, ``target``, ``expected`` copies and ``offset`` (both in ``1 / UNIT``) of every source."""
    sources = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    placed = running(
        sources, {"_none": F.isnull("source"), "_name": F.col("source")}, {"place": F.lit(1).cast("bigint")}, label="mix-order"
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("bigint")
    weighed = stage(placed.withColumn("weight", weight).withColumn("cap", MOST * F.col("source_size")), "mix-weights")
    total, heavy = weighed.agg(F.sum("source_size"), F.sum("weight")).first()

    ratio = F.col("cap").cast("double") / F.col("weight")
    order = {"_ratio": ratio, "_none": F.isnull("source"), "_name": F.col("source")}
    level = (F.lit(total or 0) - F.col("caps")).cast("double") * F.col("weight") / (F.lit(heavy or 0) - F.col("weights"))
    filled = running(weighed, order, {"caps": F.col("cap"), "weights": F.col("weight")}, label="mix-level")
    # Running sums take the place of the values they add up.
    filled = filled.select("source", "source_size", "cap", "weight", (F.col("cap") <= level).alias("full"))
    filled = stage(filled, "mix-full")
    poured, carried = filled.where("full").agg(F.sum("cap"), F.sum("weight")).first()
    rest, light = (total or 0) - (poured or 0), (heavy or 0) - (carried or 0)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        F.lit(float(rest)) * F.col("weight") / F.lit(light or None).cast("bigint")
    )
    copies = F.floor(F.col("target") / F.col("source_size") * float(UNIT) + 0.5)
    return filled.select("source", "source_size", target.alias("target")).select(
        "*",
        F.when(F.col("source_size") > 0, F.least(copies, F.lit(MOST * UNIT))).otherwise(0).cast("bigint").alias("expected"),
        offset_of(F.col("source"), seed).alias("offset"),
    )


def plan_mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: list[str] | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    seed: str = SEED,
) -> DataFrame:
    """The columns of ``keep`` (all) and ``size``, ``source_size``, ``target``, ``copies`` and ``taken``, the words of all copies."""
    names = [n for n in (docs.columns if keep is None else keep) if n not in ("size", "source_size", "target", "copies", "taken")]
    sized = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"),
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{source}`").alias("source"),
        size_of(F.col(f"`{text}`")).alias("size"),
    )
    sized = stage(sized, "mix-sizes")
    targets = stage(source_targets(sized, weights, seed), "mix-targets").withColumnRenamed("source", "_source")
    known = sized.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    begins = running(
        known,
        {"_fall": -F.col("size"), "_id": F.col("id"), "_row": F.xxhash64("row")},
        {"begins": F.col("expected").cast("decimal(38,0)")},
        group="source",
        label="mix-docs",
    )
    unit = F.lit(UNIT).cast("decimal(38,0)")
    begins = begins.withColumn("begins", (F.col("begins") + F.col("offset")).cast("decimal(38,0)"))
    begins = begins.withColumn("ends", (F.col("begins") + F.col("expected")).cast("decimal(38,0)")).withColumn("unit", unit)
    copies = F.expr("ends div unit") - F.expr("begins div unit")
    return begins.select("row.*", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed table: every document as often as it is taken, with its columns and ``copy``, counted from 1."""
    planned = plan_mix(docs, **options).where("copies > 0")
    return planned.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        *[c for c in docs.columns if c != "copy"], "copy"
    )
