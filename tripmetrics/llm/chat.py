"""Chat formatting: collapse cumulative snapshots of conversations, then render what is left.

A conversation is the set of its rows (turn, role, text); its prefix up to a turn is the set of rows up to
there. A conversation is a snapshot of a longer one if it equals one of its proper prefixes; of equal
conversations the one with the least id stays. Prefixes are compared by rolling hashes: every row has two
64-bit hashes over its turn, role and text, and a prefix the exclusive or of its rows' hashes together with its
number of rows. Hashes roll within blocks of turns and over the blocks' totals, so that one very long
conversation is spread over tasks. Equal prefixes are reduced to one before they meet in the anti-join.

Rendering joins the rows of a conversation by turn, then role and text. A conversation of more than
``BLOCK_TURNS`` turns is rendered in several parts, one row each, and one that has more than ``PART_ROWS`` rows or
``PART_BYTES`` bytes there in more; the parts in order are the whole. Parts are numbered by their keys alone, so no
task sees all texts of one conversation. Marks (``<|``) inside roles and texts are written as ``<\\|``.

Results for odd input: rows with a null id form one conversation, which loses to an equal one with an id; a null
turn comes before all others; null roles and texts differ from empty ones in comparisons and are rendered as
empty. Repeated rows count once. Empty tables give none. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmetrics.sources import stage

BLOCK_TURNS, PART_ROWS, PART_BYTES = 1024, 4096, 16 << 20


def _row_hash(salt: int) -> Column:
    parts = [F.lit(salt), F.isnull("turn"), F.coalesce("turn", F.lit(0))]
    for name in ("role", "text"):
        parts += [F.isnull(name), F.coalesce(name, F.lit(""))]
    return F.xxhash64(*parts)


def _rows(conversations: DataFrame, names: dict[str, str]) -> DataFrame:
    """Different rows; the block of a null turn is null and sorts first."""
    rows = conversations.select(*(F.col(f"`{c}`").alias(n) for n, c in names.items())).distinct()
    return rows.withColumn("block", F.expr(f"turn div {BLOCK_TURNS}") - F.when(F.col("turn") % BLOCK_TURNS < 0, 1).otherwise(0))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def prefixes(rows: DataFrame) -> DataFrame:
    """For every conversation and turn ``h1``, ``h2`` and ``n`` of the prefix, and whether it is the ``whole``."""
    sums = [F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"), F.sum("n").alias("n")]
    hashed = rows.select("conv_id", "block", "turn", _row_hash(1).alias("h1"), _row_hash(2).alias("h2"), F.lit(1).alias("n"))
    turns = stage(hashed.groupBy("conv_id", "block", "turn").agg(*sums), "chat-turns")

    in_order = W.partitionBy("conv_id").orderBy("block")
    before = in_order.rowsBetween(W.unboundedPreceding, -1)
    blocks = turns.groupBy("conv_id", "block").agg(*sums, F.count("*").alias("_turns"))
    blocks = blocks.select(
        F.col("conv_id").alias("_conv"),
        F.col("block").alias("_block"),
        F.coalesce(F.bit_xor("h1").over(before), F.lit(0)).alias("_h1"),
        F.coalesce(F.bit_xor("h2").over(before), F.lit(0)).alias("_h2"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n"),
        F.lead(F.lit(True)).over(in_order).isNull().alias("_last"),
    )
    joined = turns.join(blocks, _same("conv_id", "_conv") & _same("block", "_block"))
    by_turn = W.partitionBy("conv_id", "block").orderBy("turn")
    rolling = by_turn.rowsBetween(W.unboundedPreceding, W.currentRow)
    return joined.select(
        "conv_id",
        "turn",
        F.bit_xor("h1").over(rolling).bitwiseXOR(F.col("_h1")).alias("h1"),
        F.bit_xor("h2").over(rolling).bitwiseXOR(F.col("_h2")).alias("h2"),
        (F.sum("n").over(rolling) + F.col("_n")).alias("n"),
        (F.col("_last") & F.lead(F.lit(True)).over(by_turn).isNull()).alias("whole"),
    )


def maximal(rows: DataFrame) -> DataFrame:
    """The ids of conversations that are no snapshot of another."""
    found = stage(prefixes(rows), "chat-prefixes")
    key = ["h1", "h2", "n"]
    # The least id, null last.
    first = F.min(F.struct(F.isnull("conv_id").alias("none"), "conv_id")).alias("first")
    wholes = found.where("whole").groupBy(*key).agg(first)
    parts = found.where("NOT whole").select(*key).distinct()
    return wholes.join(parts, key, "left_anti").select(F.col("first.conv_id").alias("conv_id"))


def render(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``part``, ``n_rows`` and ``rendered``: the conversations as text, in parts where they are long."""
    size = F.octet_length(F.coalesce("role", F.lit(""))) + F.octet_length(F.coalesce("text", F.lit("")))
    pieces = F.greatest(F.ceil(F.count("*") / PART_ROWS), F.ceil(F.sum(size) / PART_BYTES))
    blocks = rows.groupBy("conv_id", "block").agg(pieces.alias("_pieces"))
    crowded = stage(blocks.where("_pieces > 1").select("conv_id", "block"), "chat-crowded")
    crowded_turns = (
        rows.join(crowded.toDF("_c", "_b"), _same("conv_id", "_c") & _same("block", "_b"), "left_semi")
        .groupBy("conv_id", "turn")
        .agg(pieces.alias("_pieces"))
        .toDF("_conv", "_turn", "_pieces")
    )
    split = rows.join(crowded_turns, _same("conv_id", "_conv") & _same("turn", "_turn"), "left")
    # A crowded block is cut by turn, and a crowded turn by the hashes of its rows.
    start = F.when(F.col("_pieces").isNotNull(), F.col("turn")).otherwise(F.col("block") * BLOCK_TURNS)
    piece = F.pmod(_row_hash(3), F.coalesce("_pieces", F.lit(1)))
    clean = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("<\\|"))
    said = F.concat(F.lit("<|"), clean("role"), F.lit("|>\n"), clean("text"), F.lit("\n<|end|>\n"))
    parts = split.select("conv_id", start.alias("_start"), piece.alias("_piece"), "turn", "role", "text", said.alias("said"))
    gathered = parts.groupBy("conv_id", "_start", "_piece").agg(
        F.count("*").alias("n_rows"), F.array_sort(F.collect_list(F.struct("turn", "role", "text", "said"))).alias("_rows")
    )
    texts = gathered.select(
        "conv_id", "_start", "_piece", "n_rows", F.array_join(F.col("_rows.said"), "").alias("rendered")
    )
    order = W.partitionBy("conv_id").orderBy("_start", "_piece")
    numbers = parts.select("conv_id", "_start", "_piece").distinct().withColumn("part", F.row_number().over(order) - 1)
    # All but the first parts, which are few: most conversations have one.
    later = stage(numbers.where("part > 0"), "chat-parts").toDF("_conv", "_from", "_of", "part")
    placed = texts.join(later, _same("conv_id", "_conv") & _same("_start", "_from") & (F.col("_piece") == F.col("_of")), "left")
    return placed.select("conv_id", F.coalesce("part", F.lit(0)).alias("part"), "n_rows", "rendered")


def format_chats(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Collapse snapshots and render the conversations that are left."""
    rows = _rows(conversations, {"conv_id": conv_id, "turn": turn, "role": role, "text": text})
    kept = stage(maximal(rows), "chat-kept").toDF("_kept")
    return render(rows.join(kept, _same("conv_id", "_kept"), "left_semi"))
