"""Hard-negative mining by segment summary filtering.

Vectors are rounded to whole numbers, ``floor(SCALE * x)``, and a score is an inner product. An anchor's positives are
its best rows of the same label; the negatives of a positive are the best rows of other labels whose score is at
least ``SHARE`` hundredths of the positive's and not above it. Equal scores go by the smaller id.

A vector is cut into segments, few and long ones on the first level and more on the next (``SEGMENTS``), and the mean
and the deviation of every segment are stored beside it. In a segment of ``L`` numbers the inner product of two vectors
is ``L`` times the product of the means, plus or minus at most ``L`` times the product of the deviations, so the sums
over segments bound the score from both sides. A pair whose upper bound can't get into what the anchor has so far, or
whose lower bound is above all that is wanted, goes without being scored; pairs that the first level leaves are
bounded again on the next one, and what is left is scored exactly. Bounds have a margin for rounding; no result is lost.

Scale: the anchors are the stated query set, and every one of them has to meet every row. Rows are dealt by a hash of
their id into groups that a task can hold (``GROUP_BYTES``), and anchors, a hundredth of the rows, are sent to every
group, so the table is shuffled once and the anchors once per group. A group is held, anchors stream past it in
Arrow batches, and each keeps its best few. Labels don't decide where a row goes, so a label with most of the rows
is as even as any other. Work grows with anchors times rows, as the question does.

Results for odd input: rows with a null id, label or vector, or any null or non-finite number take no part. Rows of the
same id count as one, that with the least label and then the least vector. Numbers beyond ``LIMIT`` after scaling count
as ``LIMIT``. Vectors of different lengths can't be compared and are never each other's positives or negatives;
those of no length have score 0. An anchor without a positive, and a positive without a negative, give no row. An empty
table gives no rows. Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmetrics.llm.batches import extended
from tripmetrics.sources import stage

SCALE, LIMIT = 256, 1 << 20
# Segments of a vector on each level.
SEGMENTS = (4, 16)
# Positives of an anchor, negatives of a positive, and the least score of a negative in hundredths of the positive's.
POSITIVES, NEGATIVES, SHARE = 5, 5, 80
# Bytes of a group that a task holds, and into how many groups a smaller table is dealt; rows in a group at least.
GROUP_BYTES, SPREAD, GROUP_ROWS = 96 << 20, 64, 512
# Anchors and rows that are compared at once.
ANCHORS, CHUNK = 512, 2048
# Pairs left from one in so many are bounded and scored all at once.
DENSE = 8
_LEAST = np.iinfo(np.int64).min


# One pair of blocks


def cuts(size: int, segments: int) -> np.ndarray:
    """Starts of nearly equal segments of ``size`` numbers; never more segments than numbers."""
    n = min(segments, size)
    return np.arange(n, dtype=np.int64) * size // max(n, 1)


def summaries(vectors: np.ndarray) -> np.ndarray:
    """Means and deviations of the segments of every level, side by side in this order."""
    size, parts = vectors.shape[1], []
    for segments in SEGMENTS:
        at = cuts(size, segments)
        if not len(at):
            continue
        length = np.diff(np.append(at, size))
        mean = np.add.reduceat(vectors, at, axis=1) / length
        off = vectors - np.repeat(mean, length, axis=1)
        parts += [mean, np.sqrt(np.add.reduceat(off * off, at, axis=1) / length)]
    return np.concatenate(parts, axis=1) if parts else np.zeros((len(vectors), 0))


def _levels(summary: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each level the means and the deviations, weighed so that plain products bound the scores.

    One more deviation stands for rounding: a millionth of the vectors' lengths.
    """
    out, at = [], 0
    for segments in SEGMENTS:
        starts = cuts(size, segments)
        n = len(starts)
        weight = np.sqrt(np.diff(np.append(starts, size)))
        mean = summary[:, at : at + n].astype(np.float64) * weight
        deviation = summary[:, at + n : at + 2 * n].astype(np.float64) * weight
        length = np.sqrt((mean * mean).sum(axis=1) + (deviation * deviation).sum(axis=1))
        out.append((mean, np.column_stack([deviation, length * 1e-3])))
        at += 2 * n
    return out


class Block:
    """The rows of a group that a task holds, in ascending order of their ids."""

    def __init__(self, pieces: list[pa.RecordBatch], size: int):
        self.size = size
        self.ids = np.concatenate([p.column("vec_id").to_numpy() for p in pieces])
        self.labels = np.concatenate([p.column("label").to_numpy() for p in pieces])
        self.vectors = np.concatenate([_matrix(p.column("vector"), size) for p in pieces])
        self.summary = np.concatenate([_matrix(p.column("summary"), _width(size)) for p in pieces])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _width(size: int) -> int:
    return sum(2 * len(cuts(size, s)) for s in SEGMENTS)


def _exact(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """All inner products. Products of doubles are exact, and fast, while every partial sum is."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(size, 1)
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Search:
    """The best few of a block for some anchors; ``pairs`` counts what is bounded and scored."""

    def __init__(self, ids, labels, vectors, summary, size: int, same: bool, low: np.ndarray, high: np.ndarray, keep: int):
        self.ids, self.labels, self.vectors, self.size, self.same = ids, labels, vectors, size, same
        self.levels = _levels(summary, size)
        # One column per wanted interval of scores; those that nothing fits have no least score.
        self.low, self.high, self.keep = low, high, keep
        self.scores = np.full((*low.shape, keep), _LEAST, np.int64)
        self.places = np.full((*low.shape, keep), -1, np.int64)
        self.pairs = [0] * (len(SEGMENTS) + 2)

    def _floors(self) -> np.ndarray:
        """Scores that still count, by anchor and interval: rows come by id, so an equal score comes too late."""
        last = self.scores[:, :, -1]
        return np.where(self.places[:, :, -1] >= 0, np.maximum(self.low, last + 1), self.low)

    def add(self, block: Block, start: int, stop: int) -> None:
        labels, ids = block.labels[start:stop], block.ids[start:stop]
        mask = (self.labels[:, None] == labels[None, :]) == self.same
        if self.same:
            mask &= self.ids[:, None] != ids[None, :]
        floors = self._floors()
        empty = floors > self.high
        least = np.where(empty, np.iinfo(np.int64).max, floors).min(axis=1).astype(np.float64)
        most = np.where(empty, _LEAST, self.high).max(axis=1).astype(np.float64)
        mask &= ~empty.all(axis=1)[:, None]
        self.pairs[0] += mask.sum()
        rows = cols = None
        for level, (mine, theirs) in enumerate(zip(self.levels, _levels(block.summary[start:stop], self.size))):
            if rows is None and mask.sum() * DENSE > mask.size:
                middle, slack = mine[0] @ theirs[0].T, mine[1] @ theirs[1].T + 0.5
                mask &= (middle + slack >= least[:, None]) & (middle - slack <= most[:, None])
                self.pairs[level + 1] += mask.sum()
                continue
            if rows is None:
                rows, cols = np.nonzero(mask)
            middle = np.einsum("ij,ij->i", mine[0][rows], theirs[0][cols])
            slack = np.einsum("ij,ij->i", mine[1][rows], theirs[1][cols]) + 0.5
            left = (middle + slack >= least[rows]) & (middle - slack <= most[rows])
            rows, cols = rows[left], cols[left]
            self.pairs[level + 1] += len(rows)
        vectors = block.vectors[start:stop]
        if rows is None:
            rows, cols = np.nonzero(mask)
        if len(rows) * DENSE > mask.size:
            scores = _exact(self.vectors, vectors, self.size)[rows, cols]
        else:
            scores = np.einsum("ij,ij->i", self.vectors[rows].astype(np.int64), vectors[cols].astype(np.int64))
        self.pairs[-1] += len(rows)
        for k in range(self.low.shape[1]):
            wanted = (scores >= floors[rows, k]) & (scores <= self.high[rows, k])
            if wanted.any():
                self._merge(k, rows[wanted], scores[wanted], cols[wanted] + start)

    def _merge(self, k: int, rows: np.ndarray, scores: np.ndarray, places: np.ndarray) -> None:
        had, slot = np.nonzero(self.places[:, k] >= 0)
        rows = np.concatenate([had, rows])
        scores = np.concatenate([self.scores[had, k, slot], scores])
        places = np.concatenate([self.places[had, k, slot], places])
        order = np.lexsort((places, -scores, rows))
        rows, scores, places = rows[order], scores[order], places[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = rank < self.keep
        self.scores[rows[kept], k, rank[kept]] = scores[kept]
        self.places[rows[kept], k, rank[kept]] = places[kept]

    def found(self, block: Block) -> pa.RecordBatch:
        """Anchor, row and score; a row that several intervals have comes once."""
        anchor, interval, slot = np.nonzero(self.places >= 0)
        place, score = self.places[anchor, interval, slot], self.scores[anchor, interval, slot]
        _, once = np.unique(anchor * (len(block.ids) + 1) + place, return_index=True)
        columns = [self.ids[anchor[once]], block.ids[place[once]], score[once]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "other_id", "score"])


def _intervals(caps: pa.Array, share: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of a negative for every positive's score; the rest of a row is empty."""
    lists = caps.to_pylist()
    shape = (len(lists), max(map(len, lists), default=0))
    low, high = np.zeros(shape, np.int64), np.full(shape, -1, np.int64)
    for i, scores in enumerate(lists):
        for j, score in enumerate(scores):
            low[i, j], high[i, j] = -(-share * score // 100), score
    return low, high


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, pa.RecordBatch]]:
    """Pieces of a batch with one group and one side each."""
    columns = [batch.column(c).to_numpy() for c in ("size", "slot", "side")]
    new = np.ones(batch.num_rows, bool)
    if batch.num_rows:
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    starts = np.flatnonzero(new)
    for start, stop in zip(starts, [*starts[1:], batch.num_rows]):
        size, slot, side = (int(c[start]) for c in columns)
        yield (size, slot), side, batch.slice(start, stop - start)


def _compare(same: bool, keep: int, share: int):
    """Of rows in the order of group and side: the rows of a group are held, then its anchors pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, pieces, block = None, [], None
        for batch in batches:
            for key, side, piece in _runs(batch):
                if key != group:
                    group, pieces, block = key, [], None
                if not side:
                    pieces.append(piece)
                    continue
                if not pieces and block is None:
                    continue
                if block is None:
                    block, pieces = Block(pieces, key[0]), []
                for start in range(0, piece.num_rows, ANCHORS):
                    part = piece.slice(start, ANCHORS)
                    if same:
                        low, high = np.full((part.num_rows, 1), _LEAST), np.full((part.num_rows, 1), np.iinfo(np.int64).max)
                    else:
                        low, high = _intervals(part.column("caps"), share)
                    own = Block([part], key[0])
                    search = Search(own.ids, own.labels, own.vectors, own.summary, key[0], same, low, high, keep)
                    for at in range(0, len(block.ids), CHUNK):
                        search.add(block, at, min(at + CHUNK, len(block.ids)))
                    yield search.found(block)

    return run


# Tables


def prepared(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", relabel: Column | None = None
) -> DataFrame:
    """``vec_id``, ``label``, ``vector`` of whole numbers and ``size`` of the rows that take part, one per id.

    ``relabel`` is an expression of ``vec_id`` and ``label`` that takes the label's place.
    """
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("bigint").alias("vec_id"),
        F.col(f"`{label}`").cast("bigint").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    sound = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(sound)
    whole = F.transform(
        "vector", lambda x: F.greatest(F.least(F.floor(x * SCALE), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int")
    )
    rows = rows.select("vec_id", (F.col("label") if relabel is None else relabel).alias("label"), whole.alias("vector"))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return rows.select("vec_id", "row.label", "row.vector", F.size("row.vector").alias("size"))


def summarised(rows: DataFrame) -> DataFrame:
    """Prepared rows with the means and deviations of their segments."""
    schema = extended(rows, "summary array<float>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, sizes = batch.column("vector"), batch.column("size").to_numpy()
            out: list = [None] * batch.num_rows
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                found = summaries(_matrix(lists.take(pa.array(at)), size).astype(np.float64)).astype(np.float32)
                for i, row in zip(at, found):
                    out[i] = row
            columns = [*batch.columns, pa.array(out, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "summary"])

    return rows.mapInArrow(run, schema)


def _groups(rows: DataFrame) -> DataFrame:
    """``size`` and ``groups``: into how many groups the rows of each length are dealt."""
    counted = rows.groupBy("size").agg(F.count("*").alias("n"))
    # A number and its share of the summaries, in a group's arrays and in the pieces that they are made from.
    held = F.col("n") * (F.col("size") * 8 + 32 + 16 * sum(SEGMENTS))
    many, few = F.ceil(held / GROUP_BYTES), F.least(F.ceil(F.col("n") / GROUP_ROWS), F.lit(SPREAD))
    return counted.select(F.col("size").alias("_size"), F.greatest(many, few).cast("int").alias("groups"))


def _meet(rows: DataFrame, anchors: DataFrame, groups: DataFrame, same: bool, keep: int, share: int) -> DataFrame:
    """``anchor_id``, ``other_id``, ``score``: for every anchor the best rows of each group of rows."""
    sized = F.col("size") == F.col("_size")
    slot = F.pmod(F.xxhash64("vec_id"), F.col("groups")).cast("int")
    none = F.expr("cast(null AS array<bigint>)")
    held = rows.join(groups, sized).withColumns({"slot": slot, "side": F.lit(0), "caps": none}).drop("_size", "groups")
    asked = anchors.join(groups, sized).withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    asked = asked.withColumn("side", F.lit(1)).drop("_size", "groups")
    dealt = held.unionByName(asked).repartition("size", "slot").sortWithinPartitions("size", "slot", "side", "vec_id")
    return dealt.mapInArrow(_compare(same, keep, share), "anchor_id bigint, other_id bigint, score bigint")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    share: int = SHARE,
    **columns,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``is_anchor`` is a condition on ``vec_id`` and ``label``; ``columns`` are those of ``prepared``.
    """
    rows = stage(summarised(prepared(vectors, **columns)), "mined-vectors")
    groups = stage(_groups(rows), "mined-groups")
    anchors = rows.where(is_anchor)
    near = _meet(rows, anchors.withColumn("caps", F.expr("cast(null AS array<bigint>)")), groups, True, positives, share)
    best = W.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")
    near = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    near = stage(near.select("anchor_id", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "mined-positives")

    caps = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set("positive_score").alias("caps"))
    far = _meet(rows, anchors.join(caps, "vec_id"), groups, False, negatives, share)
    pairs = near.join(far, "anchor_id").where(
        (share * F.col("positive_score") <= 100 * F.col("score")) & (F.col("score") <= F.col("positive_score"))
    )
    best = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "other_id")
    return (
        pairs.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
