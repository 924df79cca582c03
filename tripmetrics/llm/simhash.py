"""SimHash near-duplicates: fingerprints of word shingles, linked where few bits differ.

Words are what white space (space and bytes 9 to 13) leaves, A-Z lower-cased; shingles are ``size``
consecutive words joined by a space, repeats included. A text of fewer words has one shingle, all of its
words; one without words has fingerprint 0. A bit is set if it is set in more than half of the shingles'
XXH64 hashes (seed 42).

Search: 64 bits are cut into ``BLOCKS`` pieces, of which two fingerprints at most ``distance`` bits apart
share at least ``BLOCKS - distance``; every choice of so many pieces is a key. Fingerprints that share a key
are joined and their distance is counted. A key that many different fingerprints share is not joined with
itself: each of them is expanded into the values at ``distance / 2`` bits of it outside the key's pieces, and
those that meet at such a value are chained to the least of them. Meeting there and being within ``distance``
bits are the same, so the components are the same, without the square of the group.

Only different fingerprints are compared, so copies cost nothing here. Results for odd input: null and empty
texts have fingerprint 0 and are linked like any other; null ids have a fingerprint and the component's least
id, which is null only where all its ids are; repeated rows stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.batches import extended, free_name, slices, utf8
from tripmetrics.llm.components import components
from tripmetrics.sources import Stages

SHINGLE, DISTANCE, BLOCKS, SEED = 3, 2, 5, 42
# Fingerprints of a key up to which they are joined with each other.
JOINED_GROUP = 32
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts, stops = [0, *ends[:-size].tolist()], (ends[size - 1 :] - 1).tolist() or [len(joined)]
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for i in range(0, len(stops), _HASHES_AT_ONCE):
        part = slice(i, i + _HASHES_AT_ONCE)
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[part], stops[part])])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(stops)).view(">i8")[0])


def add_fingerprints(docs: DataFrame, text: str = "text", size: int = SHINGLE, name: str = "bits") -> DataFrame:
    """Add the fingerprint as a long in the column ``name``, which replaces one of that name."""
    kept = docs.drop(name)
    schema = extended(kept, f"{name} bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            bits = [fingerprint(t, size) for t in utf8(batch.column(text))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits, pa.int64())], schema.names)

    return kept.mapInArrow(run, schema)


def _prints(docs: DataFrame, id_column: str, text: str, size: int) -> DataFrame:
    return add_fingerprints(docs.select(id_column, text), text, size).select(id_column, "bits")


def _masks(distance: int, blocks: int) -> list[int]:
    """The bits that each key keeps, as signed numbers."""
    edges = np.linspace(0, 64, blocks + 1).astype(int)
    pieces = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [_signed(sum(c)) for c in combinations(pieces, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _flips(mask: int, radius: int) -> list[int]:
    """What to xor to reach every value within ``radius`` bits outside the mask."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [_signed(sum(1 << b for b in c)) for r in range(radius + 1) for c in combinations(free, r)]


def links(prints: DataFrame, into: Stages, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Links ``a``, ``b`` whose components are those of all pairs at most ``distance`` (even) bits apart.

    ``prints`` has different fingerprints in ``bits``. The result reads the stage ``keys`` of ``into``.
    """
    if distance % 2:
        raise ValueError("the distance must be even")
    masks = _masks(distance, blocks)
    keyed = F.explode(F.array(*[_key(i, F.col("bits").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)]))
    keys = prints.select("bits", keyed.alias("k")).select("bits", "k.*")
    sizes = keys.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = into.write(keys.join(sizes, ["mask", "key"]), "keys")
    few = shared.where(F.col("n") <= JOINED_GROUP)
    pairs = (
        few.select("mask", "key", F.col("bits").alias("a"))
        .join(few.select("mask", "key", F.col("bits").alias("b")), ["mask", "key"])
        .where(F.col("a") < F.col("b"))
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
        .select("a", "b")
    )
    many = shared.where(F.col("n") > JOINED_GROUP)
    near = F.lit(None)
    for i, m in enumerate(masks):
        near = F.when(F.col("mask") == i, F.array(*[F.lit(x) for x in _flips(m, distance // 2)])).otherwise(near)
    met = many.select("bits", F.explode(near).alias("flip")).select("bits", F.col("bits").bitwiseXOR(F.col("flip")).alias("at"))
    least = met.groupBy("at").agg(F.min("bits").alias("a"), F.count("*").alias("n")).where("n > 1")
    chained = met.join(least, "at").where(F.col("a") < F.col("bits")).select("a", F.col("bits").alias("b"))
    return pairs.unionByName(chained).distinct()


def _key(i: int, key: Column) -> Column:
    return F.struct(F.lit(i).alias("mask"), key.alias("key"))


def _grouped(prints: DataFrame, id_column: str, distance: int, into: Stages, result: bool) -> DataFrame:
    """For every fingerprint, id and fingerprint of the document that stands for its component.

    That is the document with the least id, null last, and of several fingerprints with it the least.
    """
    firsts = prints.groupBy("bits").agg(F.min(id_column).alias("first"))
    roots = components(links(firsts.select("bits"), into, distance), into)
    grouped = firsts.join(roots, F.col("bits") == F.col("node"), "left").select(
        "bits", "first", F.coalesce("root", "bits").alias("root")
    )
    rank = F.struct(F.isnull("first").alias("last"), "first", F.col("bits").alias("of"))
    best = grouped.groupBy("root").agg(F.min(rank).alias("best"))
    picked = grouped.join(best, "root").select("bits", F.col("best.first").alias("kept_id"), F.col("best.of").alias("kept_bits"))
    return into.write(picked, "groups", done=("keys", *into.live("components")), result=result)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """The id, ``fingerprint`` (16 hex digits) and ``component_id`` of every document.

    ``component_id`` is the least id that links reach, the document's own included.
    """
    with Stages(docs.sparkSession, "simhash") as own:
        prints = own.write(_prints(docs, id_column, text, size), "prints", result=True)
        groups = _grouped(prints, id_column, distance, own, True)
    return prints.join(groups, "bits").select(
        id_column, F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), F.col("kept_id").alias("component_id")
    )


def keep_first(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """One document of each component, with the columns it came with.

    It is the one with the least id. Null ids come last; of rows that share id and fingerprint the least text stays.
    """
    own, of, mark = (free_name(n, docs) for n in ("_id", "_of", "_simhash_bits"))
    with Stages(docs.sparkSession, "simhash") as stages:
        prints = stages.write(_prints(docs, id_column, text, size), "prints")
        judged = prints.join(_grouped(prints, id_column, distance, stages, False), "bits")
        is_kept = F.col(id_column).eqNullSafe(F.col("kept_id")) & (F.col("bits") == F.col("kept_bits"))
        dropped = judged.where(~is_kept).select(F.col(id_column).alias(own), F.col("bits").alias(of)).distinct()
        repeated = judged.where(is_kept).groupBy(id_column, "bits").agg(F.count("*").alias("n")).where("n > 1")
        repeated = repeated.select(F.col(id_column).alias(own), F.col("bits").alias(of))
        dropped = stages.write(dropped, "dropped", result=True)
        repeated = stages.write(repeated, "repeated", result=True)

    marked = add_fingerprints(docs, text, size, mark)
    same = F.col(f"`{id_column}`").eqNullSafe(F.col(own)) & (F.col(mark) == F.col(of))
    kept = marked.join(dropped, same, "left_anti")
    single = kept.join(repeated, same, "left_anti")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    several = kept.join(repeated, same, "left_semi").groupBy(id_column, mark).agg(F.min_by(row, text).alias(own))
    return single.select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(several.select(f"{own}.*"))
