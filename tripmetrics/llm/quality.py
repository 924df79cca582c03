"""Quality classifier: histogram gradient-boosted trees over statistics of a text.

Statistics are counts over bytes, words and lines (``STATISTICS``), computed on whole texts. The trees are
grown on a bounded sample of labelled documents (``max_rows``) with second-order histogram splits, complete
to ``depth`` and stored as arrays, so that a batch walks all of them with a few numpy steps per level.

Results for odd input: null and empty texts have all statistics at their value for no bytes and get the score
the trees give to that. Rows of ``labels`` with a null id or label are left out; of several labels of an id the
lowest counts; repeated documents with a label are all learned from and all scored. With no usable label the
score is 0.5; with one class it is that class, smoothed. Added columns replace columns of the same name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.batches import extended, free_name, slices, utf8
from tripmetrics.sources import stage

#: Labelled documents that trees are grown on, at most; the first by a hash of their ids.
MAX_ROWS = 20_000
THRESHOLD = 0.3
FOLDS = 5

_KINDS = ("lower", "upper", "digit", "space", "newline", "stop", "comma", "mark", "bar", "symbol", "other", "lead", "rest")
STATISTICS = (
    "log_bytes",
    *(f"share_{k}" for k in _KINDS),
    "log_words",
    "word_bytes",
    "distinct_words",
    "shouted_words",
    "words_ending_in_symbols",
    "log_lines",
    "distinct_lines",
    "line_words",
    "packed_size",
    "longest_word",
)


def _kind_of_byte() -> np.ndarray:
    kinds = np.full(256, _KINDS.index("other"), np.uint8)
    for name, chars in (
        ("lower", b"abcdefghijklmnopqrstuvwxyz"),
        ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        ("digit", b"0123456789"),
        ("space", b" \t"),
        ("newline", b"\r\n"),
        ("stop", b"."),
        ("comma", b",;:'\"()-"),
        ("mark", b"!?"),
        ("bar", b"|"),
        ("symbol", b"#$%&*@<>{}[]=+^~_/\\"),
    ):
        kinds[list(chars)] = _KINDS.index(name)
    kinds[0x80:0xC0] = _KINDS.index("rest")
    kinds[0xC0:] = _KINDS.index("lead")
    return kinds


_BYTE_KIND = _kind_of_byte()
_SYMBOLS = b"#$%&*!?|@<>=+^~"


def _word_statistics(text: bytes) -> list[float]:
    words = text.split()
    lines = [x for x in text.split(b"\n") if x]
    n = len(words) or 1
    ends = [w for w in words if w[-1] in _SYMBOLS]
    return [
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        len(set(words)) / n,
        sum(map(bytes.isupper, words)) / n,
        len(ends) / n,
        np.log1p(len(lines)),
        len(set(lines)) / (len(lines) or 1),
        len(words) / (len(lines) or 1),
        len(zlib.compress(text, 1)) / (len(text) + 32),
        max(map(len, words), default=0),
    ]


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ``STATISTICS`` per text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    kinds = _BYTE_KIND[np.frombuffer(b"".join(texts), np.uint8)]
    shares = np.zeros((len(texts), len(_KINDS)))
    filled = sizes > 0
    starts = (np.cumsum(sizes) - sizes)[filled]
    if len(starts):
        for k in range(len(_KINDS)):
            shares[filled, k] = np.add.reduceat((kinds == k).view(np.uint8), starts, dtype=np.int64) / sizes[filled]
    words = np.array([_word_statistics(t) for t in texts], np.float64).reshape(len(texts), -1)
    return np.column_stack([np.log1p(sizes), shares, words])


class Trees:
    """Boosted complete trees as arrays: a feature and threshold per inner node, a value per leaf."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray, depth: int):
        self.base, self.feature, self.threshold, self.value, self.depth = base, feature, threshold, value, depth

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    ridge: float = 2.0,
    least: float = 1.0,
) -> Trees:
    """Grow trees on the logistic loss. ``least`` is the smallest sum of second derivatives in a child."""
    n, width = x.shape if len(x) else (0, 0)
    inner, leaves = 2**depth - 1, 2**depth
    if not n or y.min() == y.max():
        mean = (y.sum() + 0.5) / (n + 1) if n else 0.5
        return Trees(float(np.log(mean / (1 - mean))), *(np.zeros((0, k)) for k in (inner, inner, leaves)), depth)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    flat = binned + np.arange(width) * bins
    base = float(np.log(y.mean() / (1 - y.mean())))
    raw = np.full(n, base)
    features, thresholds, values = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * (width * bins) + flat).ravel()
            g, h = (
                np.bincount(cell, np.repeat(v, width), count * width * bins).reshape(count, width, bins) for v in (grad, hess)
            )
            gl, hl = g.cumsum(2)[:, :, :-1], h.cumsum(2)[:, :, :-1]
            gt, ht = g.sum(2)[:, :, None], h.sum(2)[:, :, None]
            gr, hr = gt - gl, ht - hl
            gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - gt**2 / (ht + ridge)
            gain[(hl < least) | (hr < least)] = 0
            best = gain.reshape(count, -1).argmax(1)
            j, b = best // (bins - 1), best % (bins - 1)
            for k in range(count):
                if gain[k, j[k], b[k]] > 1e-6 and b[k] < len(edges[j[k]]):
                    feature[first + k], threshold[first + k] = j[k], edges[j[k]][b[k]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + ridge)
        raw += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(base, np.array(features), np.array(thresholds), np.array(values), depth)


def held_out(id_column: str = "doc_id", folds: int = FOLDS) -> Column:
    """Whether a document's label is kept back: its id's crc32 leaves no remainder."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % folds == 0, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_column: str = "doc_id",
    text: str = "text",
    max_rows: int = MAX_ROWS,
) -> Trees:
    """Trees from the labels that aren't kept back.

    Statistics are computed in tasks; at most ``max_rows`` ids go out and as many short rows of numbers come back.
    """
    known = labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull() & ~held_out(id_column))
    known = known.groupBy(id_column).agg(F.min(label).alias("_label"))
    sample = stage(known.orderBy(F.xxhash64(id_column), id_column).limit(max_rows), "quality-sample")
    rows = docs.select(id_column, text).join(F.broadcast(sample), id_column).select(F.col(text).alias("text"), "_label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = statistics(utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), pa.list_(pa.float64())), batch.column("_label").cast(pa.float64())], ["x", "y"]
            )

    # Repeated ids may bring more rows than ids; the limit bounds those, too.
    numbers = rows.mapInArrow(run, "x array<double>, y double").orderBy(F.xxhash64("x"), "y").limit(max_rows).collect()
    x = np.array([r.x for r in numbers], np.float64).reshape(-1, len(STATISTICS))
    return fit(x, np.array([r.y for r in numbers], np.float64))


def add_score(docs: DataFrame, trees: Trees, text: str = "text", name: str = "score") -> DataFrame:
    """Add the probability of label 1 in the column ``name``."""
    kept = docs.drop(name)
    schema = extended(kept, f"{name} double")
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            scores = sent.value.score(statistics(utf8(batch.column(text))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], schema.names)

    return kept.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score ``threshold`` or more, with the columns they came with."""
    score = free_name("_quality_score", docs)
    scored = add_score(docs, train(docs, labels), name=score)
    return scored.where(F.col(score) >= threshold).select(*(F.col(f"`{c}`") for c in docs.columns))
