"""Merkle manifest of a dataset: a hash tree per group, a tree over the groups, proofs and their verification.

A leaf is the hash of a row's fields. In every group leaves ascend by id and every ``FANOUT`` consecutive ones become
their hash, until one is left, the group's subroot; the subroots, in the order of the groups, become the root likewise.

Slot pivot: a node knows its place in its level, so its parent's place and its slot follow by division. One
grouped table a level spreads the children of each parent into ``FANOUT`` columns by conditional aggregates. All columns
joined and hashed are the parent; a child's siblings are the same columns without its own, those to the left and those
to the right. Proofs go down again: a parent's path is handed to its children by one join a level, and the leaves come
out of the lowest pivot itself, which carries their ids. Verification folds a leaf with the path.

Everything is built-in functions. Scale: texts are hashed where they are read and never shuffled. Levels shrink by the
fan-out, so all of them together move little more than the leaves' hashes; paths are made once per parent. Every
level is written, so a lost executor repeats one of them. A group with most of the rows is many parents.

Results for odd input: a null field counts as ``-``; an empty text has 0 bytes. A null group is a group and comes first,
null ids come first in their group. Repeated rows are leaves of their own, next to each other; rows with the same id go
by their hash. A group of one row has its leaf as subroot, a single group its subroot as root. An empty table gives no
rows. Very long texts are hashed whole. Other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.ordering import running
from tripmetrics.sources import stage

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SLOTS = [f"c{k}" for k in range(FANOUT)]


def encoded(value: Column) -> Column:
    """A field as it is hashed: its bytes in UTF-8 with their number before them, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def lower_case(text: Column) -> Column:
    """A to Z lower-cased; a null stays."""
    return F.translate(text, UPPER, LOWER)


def is_tampered(number: Column) -> Column:
    """Whether 3 divides the CRC-32 of a number's digits; not so for null."""
    return F.coalesce(F.crc32(number.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def hash_rows(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_column: str = "doc_id", group: str = "lang", text: str = "text") -> DataFrame:
    """``id``, ``key`` of the group, ``leaf``, and ``other``, the leaf after tampering where a row is tampered with.

    Keys are never null and their order is that of the groups, null first.
    """
    own = {n: F.col(f"`{n}`") for n in {*fields, id_column, group, text}}
    changed = [encoded(lower_case(own[n]) if n == text else own[n]) for n in fields]
    return docs.select(
        own[id_column].alias("id"),
        F.coalesce(F.concat(F.lit("v"), own[group]), F.lit("-")).alias("key"),
        digest(*[encoded(own[n]) for n in fields]).alias("leaf"),
        F.when(is_tampered(own[id_column]), digest(*changed)).alias("other"),
    )


def spread(nodes: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """The slot pivot of one level: a row per parent with its children's hashes in ``c0`` to ``c7``.

    ``nodes`` has ``key``, ``place``, ``n`` (nodes of that key on this level) and ``hash``. Columns ``carried`` are
    spread as well, as ``id0`` to ``id7`` for ``id``.
    """
    slot = F.pmod("place", F.lit(FANOUT))
    cells = [
        F.max(F.when(slot == k, F.col(name))).alias(f"{'c' if name == 'hash' else name}{k}")
        for name in ("hash", *carried)
        for k in range(FANOUT)
    ]
    parent = F.expr(f"place div {FANOUT}").alias("place")
    return nodes.groupBy("key", parent).agg(F.max("n").alias("n"), *cells)


def parents(pivot: DataFrame) -> DataFrame:
    """The level above: every parent's hash over its children."""
    n = F.expr(f"(n + {FANOUT - 1}) div {FANOUT}")
    return pivot.select("key", "place", n.alias("n"), F.sha2(F.concat_ws("", *_SLOTS), 256).alias("hash"))


def build(nodes: DataFrame, label: str, carried: tuple[str, ...] = ()) -> tuple[list[DataFrame], DataFrame]:
    """The pivots of all levels, lowest first, and ``key``, ``height``, ``hash`` of every tree's top."""
    pivots, tops, level = [], [], nodes
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        height = F.lit(len(pivots)).alias("height")
        tops.append(level.where("n = 1").select("key", height, "hash"))
        if most <= 1:
            break
        pivot = stage(spread(level.where("n > 1"), () if pivots else carried), f"{label}-level")
        pivots.append(pivot)
        level, most = parents(pivot), -(-most // FANOUT)
    top = tops[0]
    for others in tops[1:]:
        top = top.unionByName(others)
    return pivots, stage(top, f"{label}-tops")


def _children(pivot: DataFrame, above: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """A row per child of ``pivot``: its place, its hash, what is carried, and its path, which begins with its siblings."""
    joined = pivot.drop("n").join(above.drop("hash"), ["key", "place"])
    cells = [
        F.struct(
            (F.col("place") * FANOUT + k).alias("place"),
            F.col(_SLOTS[k]).alias("hash"),
            *[F.col(f"{name}{k}").alias(name) for name in carried],
            F.struct(
                F.concat_ws("", *_SLOTS[:k]).alias("left"), F.concat_ws("", *_SLOTS[k + 1 :]).alias("right")
            ).alias("siblings"),
        )
        for k in range(FANOUT)
    ]
    rows = joined.select("key", "subroot", F.col("path").alias("upper"), F.explode(F.array(*cells)).alias("child"))
    rows = rows.select("key", "subroot", "upper", "child.*").where("hash IS NOT NULL")
    return rows.withColumn("path", F.concat(F.array("siblings"), "upper")).drop("siblings", "upper")


def paths(pivots: list[DataFrame], tops: DataFrame, leaves: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``place``, ``hash``, ``subroot``, ``path`` and what is carried for every leaf.

    ``tops`` has ``key``, ``height``, ``subroot`` and the ``path`` from there on. Leaves that are the top
    of their tree come from ``leaves``, all others from the lowest pivot.
    """
    def begin(height: int) -> DataFrame:
        at = tops.where(F.col("height") == height)
        return at.select("key", F.lit(0).cast("bigint").alias("place"), F.col("subroot").alias("hash"), "subroot", "path")

    above = begin(len(pivots))
    for height in range(len(pivots) - 1, -1, -1):
        down = _children(pivots[height], above, () if height else carried)
        above = down.unionByName(begin(height)) if height else down
    names = ["key", "place", "hash", *carried, "subroot", "path"]
    alone = leaves.where("n = 1").join(tops.where("height = 0").drop("height"), "key").select(*names)
    return above.select(*names).unionByName(alone) if pivots else alone


def proof_of(path: Column) -> Column:
    """Hash of all siblings, the lowest level first."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda own, s: F.sha2(F.concat(s["left"], own, s["right"]), 256))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_column: str = "doc_id", group: str = "lang", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``key``, ``leaf``, ``other``, ``subroot``, ``root`` and the ``path``.

    ``path`` has the siblings of every level from the leaf to the root, as texts to the left and to the right.
    """
    rows = stage(hash_rows(docs, fields, id_column, group, text), "merkle-leaves")
    order = {"_id": F.col("id"), "_leaf": F.col("leaf")}
    placed = running(rows, order, {"place": F.lit(1).cast("bigint")}, group="key", label="merkle-order")
    counts = rows.groupBy("key").agg(F.count("*").alias("n"))
    leaves = placed.join(counts, "key").withColumnRenamed("leaf", "hash")
    leaves = stage(leaves, "merkle-placed")
    pivots, tops = build(leaves, "merkle", ("id", "other"))

    # The tree over the groups: one key, and the groups' keys are carried.
    groups = running(tops, {"_key": F.col("key")}, {"place": F.lit(1).cast("bigint")}, label="merkle-groups")
    n_groups = tops.count()
    groups = groups.select(F.lit("").alias("key"), "place", F.lit(n_groups).cast("bigint").alias("n"), "hash", F.col("key").alias("of"))
    groups = stage(groups, "merkle-subroots")
    upper, top = build(groups, "merkle-upper", ("of",))
    whole = top.first()
    root = whole["hash"] if whole else None
    ends = top.select("key", "height", F.col("hash").alias("subroot"), F.expr("cast(array() AS array<struct<left string, right string>>)").alias("path"))
    over = paths(upper, ends, groups, ("of",)).select(F.col("of").alias("key"), "path")
    tops = stage(tops.withColumnRenamed("hash", "subroot").join(over, "key"), "merkle-paths")
    found = paths(pivots, tops, leaves, ("id", "other"))
    return found.select("id", "key", F.col("hash").alias("leaf"), "other", "subroot", F.lit(root).cast("string").alias("root"), "path")


def verify(docs: DataFrame) -> DataFrame:
    """Every row's leaf, roots, proof, and what the root becomes with the row as it is after tampering."""
    rows = manifest(docs)
    folded = fold(F.coalesce("other", "leaf"), F.col("path"))
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_of(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
