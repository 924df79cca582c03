"""A corpus from raw documents to token ids: score, drop repeated lines and documents, decontaminate, encode.

Every stage works on all that the one before kept and is written as Parquet before the next one reads it, so a
lost executor repeats at most one stage.

Results for odd input, stage by stage: a null or empty text is scored like any other, has one blank line that never
repeats, fingerprint zero, no benchmark words and no ids; of documents with equal fingerprints, null and empty texts
included, the one with the least id stays, null last, and of repeated rows one. Very long texts are processed whole. An
empty table gives an empty result. Columns other than ``doc_id``, ``text`` and ``n_chars`` are handed through, whatever
their names, up to the last stage, in which added columns replace columns of the same name.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripmetrics.llm import bpe, decontaminate, line_dedup, quality, queries, simhash
from tripmetrics.llm.shipping import shipped
from tripmetrics.sources import stage


@shipped
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at its threshold or higher; labels come from the given tables."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@shipped
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier line of the corpus equals within the edits that op1 allows for its length.

    Short lines, such as headings and names, stay in a text that has a line of its own besides.
    """
    return line_dedup.drop_repeated_lines(
        docs, line_dedup.edits_allowed, 1, count="n_chars", keep_under=line_dedup.MIN_CHARS
    )


@shipped
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: three-word shingles, at most two different bits."""
    return simhash.keep_first(docs, size=simhash.SHINGLE, distance=simhash.DISTANCE)


@shipped
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten benchmark words occurs."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@shipped
def encode_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document's text, with digests of the ids and of what they decode to."""
    return bpe.digests(docs, public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_lines),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("bpe", encode_ids),
]

# Edit distances, gradient-boosted trees and BPE have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
