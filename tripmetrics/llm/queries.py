"""The registered queries of this package: each applies its operator to the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmetrics.llm import (
    bpe,
    chat,
    decontaminate,
    hard_negatives,
    line_dedup,
    merkle,
    mixing,
    quality,
    simhash,
    spotsigs,
    token_files,
    url_filter,
    warc,
)
from tripmetrics.llm.shipping import shipped

#: Fixed rules of the URL query.
URL_RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
RANKS = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
END_ID = 0


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line with the first line of its class and the number of lines linked to it."""
    return line_dedup.line_classes(_table(spark, sf_dir, "documents"), tau=line_dedup.edits_allowed, min_chars=1).drop("h1")


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    trees = quality.train(docs, _table(spark, sf_dir, "labels"))
    scored = quality.add_score(docs.select("doc_id", "text"), trees)
    return scored.select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def url_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark_passages(docs, _table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_and_read(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def spotsigs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edit_and_compare(_table(spark, sf_dir, "documents"))


def token_file_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_read(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID)


def chat_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(_table(spark, sf_dir, "conversations"))


def hard_negative_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth id is an anchor; every seventh has the next of ten labels."""
    number, label = F.col("vec_id"), F.col("label")
    relabel = F.when(number % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), number % 100 == 0, relabel=relabel)


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document the mix takes; ``copies`` follows the columns of the contract."""
    planned = mixing.plan_mix(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return planned.select("doc_id", "size", "source_size", "target", "taken", "copies")


def merkle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, and whether the root still follows from it after tampering."""
    return merkle.verify(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": shipped(line_dedup_query),
    "op2_quality": shipped(quality_query),
    "op3_url_filter": shipped(url_query),
    "op4_decontamination": shipped(decontamination_query),
    "op5_warc": shipped(warc_query),
    "op6_bpe": shipped(bpe_query),
    "op7_simhash": shipped(simhash_query),
    "op8_spotsigs": shipped(spotsigs_query),
    "op9_token_files": shipped(token_file_query),
    "op10_chat": shipped(chat_query),
    "op11_hard_negatives": shipped(hard_negative_query),
    "op12_mixing": shipped(mixing_query),
    "op13_merkle": shipped(merkle_query),
}
