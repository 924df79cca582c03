"""Benchmark decontamination: Wu-Manber search for benchmark passages over words.

Words are runs of digits, letters a-z after lower-casing A-Z, and bytes above ASCII. A window is ``size``
consecutive words of a benchmark item; an item of fewer words, but at least one, is one window. All windows
of one length are searched together: blocks of two words index a shift table that says how far the search
may move on, windows are kept in buckets by their last block, and a direct comparison confirms.

Results for odd input: a null or empty text has no words and no hits. An item without words has no windows.
An item with a null id is searched and its words count as hits, but it can't be listed. Repeated items and
windows count once per item id. Repeated documents are judged one by one. An empty benchmark hits nothing.
Added columns replace columns of the same name.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.batches import extended, slices, utf8
from tripmetrics.sources import stage

WINDOW = 10
# Benchmark text up to this size is searched for in one pass; more goes in several passes over the documents. A pass's
# windows take about 120 times their text in a Python worker.
MAX_PASS_BYTES = 2 << 20
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
_ADDED = {
    "n_words": ("long", pa.int64()),
    "n_hit": ("long", pa.int64()),
    "n_items": ("long", pa.int64()),
    "items": ("array<string>", pa.list_(pa.string())),
    "hit_spans": ("array<struct<start:long,stop:long>>", pa.list_(_SPAN)),
}


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class WuManber:
    """All occurrences of patterns of one length; the alphabet is words."""

    def __init__(self, patterns: Iterable[tuple[bytes, ...]]):
        self.patterns = list(patterns)
        self.length = m = len(self.patterns[0])
        self.block = b = min(2, m)
        self.far = m - b + 1
        # By a block's last word and, in blocks of two, its first.
        self.shift: dict[bytes, dict[bytes, int]] = defaultdict(dict)
        self.buckets: dict[tuple[bytes, bytes], list[int]] = defaultdict(list)
        for k, pattern in enumerate(self.patterns):
            for end in range(b - 1, m):
                row, first = self.shift[pattern[end]], pattern[end - b + 1]
                row[first] = min(row.get(first, self.far), m - 1 - end)
            self.buckets[pattern[-1], pattern[-b]].append(k)
        self.shift = dict(self.shift)

    def search(self, text: list[bytes]) -> Iterator[tuple[int, int]]:
        """First word and pattern number of every occurrence, by first word."""
        m, far, row_of, back = self.length, self.far, self.shift.get, self.block - 1
        end, n = m - 1, len(text)
        while end < n:
            row = row_of(text[end])
            if row is None:
                end += far
                continue
            move = row.get(text[end - back], far)
            if move:
                end += move
                continue
            start = end - m + 1
            for k in self.buckets[text[end], text[end - back]]:
                if all(map(bytes.__eq__, self.patterns[k], text[start : end + 1])):
                    yield start, k
            end += 1


class Passages:
    """The windows of benchmark items, ready to search for."""

    def __init__(self, items: Iterable[tuple[str | None, bytes]], size: int = WINDOW):
        owners: dict[tuple[bytes, ...], set[str | None]] = defaultdict(set)
        for item, text in items:
            w = words(text)
            for i in range(max(1, len(w) - size + 1) if w else 0):
                owners[tuple(w[i : i + size])].add(item)
        by_length: dict[int, list[tuple[bytes, ...]]] = defaultdict(list)
        for window in owners:
            by_length[len(window)].append(window)
        self.owners = owners
        self.machines = [WuManber(v) for _, v in sorted(by_length.items())]

    def find(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, hit stretches of words in order and without overlap, ids of items found."""
        w = words(text)
        found, items = [], set()
        for machine in self.machines:
            for start, k in machine.search(w):
                found.append((start, start + machine.length))
                items |= self.owners[machine.patterns[k]]
        return len(w), merge(found), {i for i in items if i is not None}


_BUILT: dict[tuple, Passages] = {}


def _passages(items: tuple, size: int) -> Passages:
    """The windows of one pass, built once per Python worker."""
    key = (items, size)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Passages(items, size)
    return _BUILT[key]


def merge(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def mark_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    max_pass_bytes: int = MAX_PASS_BYTES,
    prefix: str = "",
) -> DataFrame:
    """Add, with ``prefix`` before each name, ``n_words``, ``n_hit``, ``n_items``, ``items`` and ``hit_spans`` (in words) to ``docs``.

    The benchmark's size is measured. Up to ``max_pass_bytes`` of its text go to every executor at once; a
    larger one is split by a hash of its texts, and the documents are passed over once for each part, with
    what was found written to the shared folder between passes.
    """
    wanted = benchmark.select(F.col(item).cast("string").alias("item"), F.encode(item_text, "UTF-8").alias("text"))
    wanted = wanted.where("text IS NOT NULL")
    bytes_in_all = wanted.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = int(bytes_in_all // max_pass_bytes) + 1
    out = docs.drop(*(prefix + n for n in _ADDED))
    for part in range(parts):
        chosen = wanted.where(F.pmod(F.xxhash64("text", "item"), F.lit(parts)) == part) if parts > 1 else wanted
        out = _pass(out, [(r.item, bytes(r.text)) for r in chosen.collect()], text, size, part > 0, prefix)
        if part + 1 < parts:
            out = stage(out, "passages")
    return out


def _pass(docs: DataFrame, items: list, text: str, size: int, again: bool, prefix: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)
    added = [prefix + n for n in _ADDED]
    kinds = ", ".join(f"{name} {kind}" for name, (kind, _) in zip(added, _ADDED.values()))
    schema = docs.schema if again else extended(docs, kinds)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = _passages(tuple(sent.value), size)
        for batch in slices(batches, text):
            before = zip(*(batch.column(added[k]).to_pylist() for k in (4, 3))) if again else None
            rows = []
            for raw in utf8(batch.column(text)):
                n, spans, found = passages.find(raw)
                if before:
                    old_spans, old_items = next(before)
                    spans = merge([*spans, *((s["start"], s["stop"]) for s in old_spans)])
                    found |= set(old_items)
                hit = sum(b - a for a, b in spans)
                rows.append((n, hit, len(found), sorted(found), [{"start": a, "stop": b} for a, b in spans]))
            kept = batch.drop_columns(added) if again else batch
            columns = [pa.array(c, t) for c, (_, t) in zip(zip(*rows), _ADDED.values())]
            yield pa.RecordBatch.from_arrays([*kept.columns, *columns], [*kept.schema.names, *added])

    return docs.mapInArrow(search, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents in which no window occurs, with the columns they came with."""
    marked = mark_passages(docs, benchmark, size=size, prefix="_passages_")
    return marked.where("_passages_n_hit = 0").select(*(F.col(f"`{c}`") for c in docs.columns))
