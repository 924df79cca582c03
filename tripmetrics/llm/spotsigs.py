"""SpotSigs fingerprints: chains of content words behind common-word anchors. Built-in functions only.

Words are runs of letters and digits in lower case. An anchor in a text, followed by the next two content words,
common words skipped, is a chain; the fingerprint is the set of the chains' 64-bit hashes, ascending, 16 hex
digits each. A text without chains (no anchors, or under two content words after them) takes its pairs of
neighbouring words instead, and one of a single word that word. The likeness of two fingerprints is the Jaccard
similarity of their sets; two empty ones are alike.

For a search, sets are partitioned by their lengths so that sets of at least the wanted likeness lie in the same
or in neighbouring partitions; pairs whose lengths rule the likeness out are not compared.

Results for odd input: null, empty and wordless texts have an empty fingerprint. Documents are ordered by id, null
first; the next document of a row is the first by text of those with the next different id, and of the last the
one with the first; repeated rows give one row each. One document alone is its own next. An empty table gives no
rows. Other columns are not used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmetrics.sources import Stages, stage

# Fixed word lists: English, French, Spanish, German. Anchors begin chains, all common words are skipped in them.
ANCHORS = (
    "a an the is was it this that "
    "le la les un une est des du "
    "el los las una es del lo su "
    "der die das ein eine ist den dem"
).split()
COMMON = (
    *ANCHORS,
    *(
        "and of to in for on with by at as are be from or not he you have were had but his they which "
        "et de en que qui dans pour par sur au avec ne pas se il "
        "y que en se con por para al como más no "
        "und in zu von mit auf für im nicht sich auch als an"
    ).split(),
)


def add_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``, the sorted hashes of a text's chains."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    # Common words end in a blank and content words in a line end, so a line is a content word after the common ones.
    marked = F.transform("_words", lambda w: F.concat(w, F.when(w.isin(*COMMON), " ").otherwise("\n")))
    lines = F.split(F.array_join(marked, ""), "\n")
    out = df.withColumn("_words", words).withColumn("_lines", lines)
    content = lambda line: F.substring_index(line, " ", -1)
    chains = F.zip_with(
        F.slice("_lines", 1, F.greatest(F.size("_lines") - 2, F.lit(0))),
        F.slice("_lines", 2, F.greatest(F.size("_lines") - 2, F.lit(0))),
        lambda line, after: F.when(
            F.contains(line, F.lit(" ")),
            F.transform(
                F.filter(F.split(line, " "), lambda w: w.isin(*ANCHORS)),
                lambda w: F.xxhash64(w, content(line), content(after)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    out = out.withColumn("_chains", F.array_distinct(F.flatten(chains)))
    pairs = F.zip_with(
        F.slice("_words", 1, F.greatest(F.size("_words") - 1, F.lit(1))),
        F.slice("_words", 2, F.greatest(F.size("_words") - 1, F.lit(1))),
        lambda a, b: F.xxhash64(a, F.coalesce(b, F.lit(""))),
    )
    chosen = F.when(F.size("_chains") > 0, F.col("_chains")).otherwise(F.array_distinct(pairs))
    return out.withColumn(name, F.sort_array(chosen)).drop("_words", "_lines", "_chains")


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def likeness(a: str, b: str, least: float = 0.0) -> Column:
    """Jaccard similarity of two fingerprint columns, or 0 where the lengths alone show it is under ``least``."""
    short, long = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(F.col(a), F.col(b)))
    return (
        F.when(long == 0, 1.0)
        .when(short < least * long, 0.0)
        .otherwise(shared / (F.size(a) + F.size(b) - shared).cast("double"))
    )


def length_partition(size: Column, least: float) -> Column:
    """Sets of at least ``least`` likeness are in the same or in neighbouring partitions."""
    return F.floor(F.log(F.greatest(size, F.lit(1))) / F.lit(-math.log(least))).cast("int")


def similar_pairs(prints: DataFrame, least: float = 0.8) -> DataFrame:
    """``a``, ``b``, ``likeness``: the pairs of different fingerprints (``id``, ``hashes``) that are alike enough.

    ``prints`` has one row per fingerprint; ids stand for classes of copies. Hashes of a set are ordered from rare
    to frequent; two sets that are alike enough share one of the first ``n - ceil(least n) + 1``. These are joined
    within a length partition and its neighbour, each pair is compared once, and only if its lengths allow it.
    """
    sets = prints.where(F.size("hashes") > 0).select("id", "hashes", F.size("hashes").alias("n"))
    sets = sets.withColumn("slot", length_partition(F.col("n"), least))
    single = sets.select("id", "n", "slot", F.explode("hashes").alias("hash"))
    often = single.groupBy("hash").agg(F.count("*").alias("f"))
    in_order = W.partitionBy("id").orderBy("f", "hash")
    ranked = single.join(often, "hash").withColumn("r", F.row_number().over(in_order))
    head = ranked.where(F.col("r") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).select("id", "n", "slot", "hash")
    head = stage(head, "spots-heads")
    other = head.toDF("b", "m", "_slot", "hash").withColumn("slot", F.explode(F.array(F.col("_slot"), F.col("_slot") - 1)))
    met = head.toDF("a", "n", "slot", "hash").join(other, ["slot", "hash"])
    once = (F.col("slot") < F.col("_slot")) | (F.col("a") < F.col("b"))
    fits = F.least("n", "m") >= F.greatest("n", "m") * least - 1e-9
    pairs = met.where((F.col("a") != F.col("b")) & once & fits).select("a", "b").distinct()
    full = sets.select("id", "hashes")
    compared = pairs.join(full.toDF("a", "_x"), "a").join(full.toDF("b", "_y"), "b")
    scored = compared.withColumn("likeness", likeness("_x", "_y", least)).where(F.col("likeness") >= least - 1e-9)
    return scored.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness")


def _neighbours(docs: DataFrame, into: Stages) -> DataFrame:
    """For every different id the one before it, how many characters that one's longest text takes, and its rows.

    Only ids and lengths are ranged over tasks. Each task's ids are in order; its first one follows the last of
    the task before, which one row per task tells. The result reads the stage ``ids`` of ``into``.
    """
    ids = docs.groupBy("doc_id").agg(
        F.max(F.expr("char_length(coalesce(text, '')) div 2")).alias("half"), F.count("*").alias("copies")
    )
    known = F.isnotnull("doc_id").alias("known")
    ranged = ids.select(known, "doc_id", "half", "copies").repartitionByRange("known", "doc_id")
    ranged = into.write(ranged.withColumn("slot", F.spark_partition_id()), "ids")
    row = F.struct("known", "doc_id", "half")
    ends = ranged.groupBy("slot").agg(F.max(row).alias("last"))
    by_slot = W.orderBy("slot")
    everything = by_slot.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ends = ends.select("slot", F.coalesce(F.lag("last").over(by_slot), F.last("last").over(everything)).alias("before"))
    in_slot = W.partitionBy("slot").orderBy("known", "doc_id")
    found = ranged.withColumn("own", F.lag(row).over(in_slot)).join(ends, "slot")
    before = F.coalesce("own", "before")
    return found.select(
        F.col("doc_id").alias("_id"), before["doc_id"].alias("before_id"), before["half"].alias("half"), "copies"
    )


def edit_and_compare(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of the text whose second half is taken from the next document, and likenesses.

    Returns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next``. A document's own text is shuffled once, and of the next one only the beginning that is needed.
    """
    texts = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    with Stages(docs.sparkSession, "spots") as own:
        near = own.write(_neighbours(texts, own), "next", done=("ids",), result=True)
    placed = texts.join(near, F.col("doc_id").eqNullSafe(F.col("_id")))
    starts = add_fingerprint(placed.select("before_id", "half", "copies", "text"), "text", "next_hashes")
    starts = starts.withColumn("start", F.expr("left(text, cast(half AS int))"))
    single = starts.where("copies = 1").select("before_id", "start", "next_hashes")
    repeated = (
        starts.where("copies > 1")
        .groupBy("before_id")
        .agg(F.min_by(F.struct("start", "next_hashes"), "text").alias("first"))
        .select("before_id", "first.start", "first.next_hashes")
    )
    both = texts.join(single.unionByName(repeated), F.col("doc_id").eqNullSafe(F.col("before_id")))
    both = both.withColumn("n_chars", F.char_length("text").cast("bigint"))
    half = "cast(n_chars div 2 AS int)"
    edited = F.expr(f"concat(left(text, cast(n_chars AS int) - {half}), left(start, {half}))")
    both = add_fingerprint(both.withColumn("edited", edited), "text", "hashes")
    both = add_fingerprint(both, "edited", "edited_hashes")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("hashes")).alias("fingerprint"),
        as_text(F.col("edited_hashes")).alias("edited_fingerprint"),
        likeness("hashes", "edited_hashes").alias("near_edited"),
        likeness("hashes", "next_hashes").alias("near_next"),
    )
