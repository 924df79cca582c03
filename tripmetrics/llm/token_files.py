"""Token-id files: an adaptive context-mixing range coder over blocks of ids.

A block has up to ``BLOCK_IDS`` ids, begins with a fresh model and ends with a checksum, so any block can be
decoded alone. Its head lists the different ids in it; the coder works on their numbers. Three predictors are
mixed at every id: order 0 gives each number its count so far, order 1 names the number that last followed the
previous one, order 2 the one that last followed the two previous ones. What orders 1 and 2 add to the number
they name follows from how often each was right in the block so far. The sum drives a carry-less range coder
with 64-bit registers and 16-bit output. Counts and weights are renewed every ``EPOCH`` ids.

All numbers of a step are taken from many blocks at once: block by block is one lane of numpy arrays, and the
steps of the lanes run together. Lanes don't touch each other, so a file does not depend on how many ran.

A file is: magic, blocks, a table of documents (id, number of ids), and a foot that says where things are.
Files belong to ranges of document ids; a manifest with one row per file gives their order.

Results for odd input: null and empty texts have only the end id. A null document id is kept and comes first.
Repeated rows are written one after the other, equal ids ordered by their texts. An empty table gives no files.
A long document runs on over blocks. Other columns are not written.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmetrics.llm.batches import slices
from tripmetrics.llm.bpe import codec, texts_of
from tripmetrics.llm.files import attempt_name, filesystem
from tripmetrics.sources import scratch_path, stage

BLOCK_IDS, LANES = 2048, 2048
EPOCH = 128
# Ids in a file, about; a document is never cut.
FILE_IDS = 32 << 20
# And beyond so many documents: of empty texts there may be as many as ids.
FILE_DOCS = 1 << 20
_ROWS_OUT = 20_000
MAGIC = b"IDMIX1\n\0"
_PAIRS = 1024
# Ids below this are numbered by a table.
_TABLE = 1 << 18
_STEP, _MOST = 24, 64
_NEVER = np.int32(2**31 - 1)
_TOP, _BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
_ALL, _WORD, _LOW = np.uint64((1 << 64) - 1), np.uint64(16), np.uint64((1 << 32) - 1)
_HEAD, _FOOT = struct.Struct("<IIIII"), struct.Struct("<QQQ8s")


class _Lanes:
    """Models and range coder of blocks that run together. Lanes are ordered by length, the longest first.

    Tables of all lanes are flat arrays; ``rows`` has where each lane begins.
    """

    def __init__(self, sizes: np.ndarray, lengths: np.ndarray):
        n, width = len(sizes), int(sizes.max())
        self.n, self.width, self.lengths, self.falling = n, width, lengths, -lengths
        self.row = np.arange(n)
        # A row of sums is padded to a power of two, so that the search needs no bounds.
        self.levels = width.bit_length()
        self.stride = 1 << self.levels
        self.sums = np.full((n, self.stride), _NEVER, np.int32)
        self.sum_rows, self.count_rows, self.after_rows, self.pair_rows = (
            self.row * k for k in (self.stride, width, width + 1, _PAIRS)
        )
        self.counts = np.where(np.arange(width) < sizes[:, None], 1, 0).astype(np.int32).ravel()
        self.after = np.full(n * (width + 1), -1, np.int32)
        self.pair = np.full(n * _PAIRS, -1, np.int32)
        # Before its first ids a lane's context is a number that it has not, whatever runs beside it.
        self.one, self.two = sizes.astype(np.int64), sizes.astype(np.int64)
        self.hits, self.misses = np.zeros((2, n), np.int32), np.zeros((2, n), np.int32)
        self.low, self.range = np.zeros(n, np.uint64), np.full(n, _ALL)
        self.renew(n)

    def renew(self, k: int) -> None:
        counts = self.counts[: k * self.width].reshape(k, self.width)
        self.sums[:k, 0] = 0
        np.cumsum(counts, axis=1, out=self.sums[:k, 1 : self.width + 1])
        self.flat = self.sums.reshape(-1)
        total = self.sums[:k, self.width].astype(np.int64)
        share = (4 * self.hits[:, :k] + 1) * total
        # All that is mixed stays far below 2 ** 31: a block's counts are at most its ids times the step.
        self.weights = np.clip(share // (4 * self.misses[:, :k] + _STEP), 1, _MOST * total).astype(np.int32)
        self.total = total.astype(np.int32)

    def alive(self, t: int) -> int:
        return int(np.searchsorted(self.falling, -t, "left"))

    def predict(self, k: int) -> None:
        """The numbers that orders 1 and 2 name and their weights; where there is none, 0 with no weight."""
        self.after_at = self.after_rows[:k] + self.one[:k]
        self.pair_at = self.pair_rows[:k] + ((self.two[:k] * 31 + self.one[:k] * 2) & (_PAIRS - 1))
        named = self.after.take(self.after_at), self.pair.take(self.pair_at)
        self.w1, self.w2 = (w[:k] * (x >= 0) for w, x in zip(self.weights, named))
        self.n1, self.n2 = (np.maximum(x, 0) for x in named)
        self.mixed = self.total[:k] + self.w1 + self.w2

    def interval(self, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of a number in the mixture."""
        at = self.sum_rows[:k] + s
        below = self.flat.take(at)
        start = below + self.w1 * (self.n1 < s) + self.w2 * (self.n2 < s)
        wide = self.flat.take(at + 1) - below + self.w1 * (self.n1 == s) + self.w2 * (self.n2 == s)
        return start, wide

    def find(self, v: np.ndarray, k: int) -> np.ndarray:
        """The number whose interval holds ``v``: what named numbers add is taken off, then sums are searched."""
        rest = v.copy()
        inside = []
        for n, w, m, u in ((self.n1, self.w1, self.n2, self.w2), (self.n2, self.w2, self.n1, self.w1)):
            at = self.sum_rows[:k] + n
            below = self.flat.take(at)
            beyond = v - below - u * (m < n)
            past = beyond >= self.flat.take(at + 1) - below + w + u * (m == n)
            rest -= w * past
            inside.append(((beyond >= 0) & ~past, below))
        # Inside a named number's interval its own sum is looked for.
        for held, below in inside:
            rest = np.where(held, below, rest)
        at = self.sum_rows[:k].copy()
        for level in range(self.levels - 1, -1, -1):
            at += (self.flat.take(at + (1 << level)) <= rest) << level
        return at - self.sum_rows[:k]

    def learn(self, s: np.ndarray, k: int) -> None:
        for i, (n, w) in enumerate(((self.n1, self.w1), (self.n2, self.w2))):
            known, right = w > 0, n == s
            self.hits[i, :k] += known & right
            self.misses[i, :k] += known & ~right
        self.counts[self.count_rows[:k] + s] += _STEP
        self.after[self.after_at] = s
        self.pair[self.pair_at] = s
        self.two[:k] = self.one[:k]
        self.one[:k] = s

    def narrow(self, unit: np.ndarray, start: np.ndarray, wide: np.ndarray, k: int, shift: Callable[[np.ndarray], None]) -> None:
        """Narrow the ranges and shift settled words out; ``shift`` is given the lanes that do."""
        self.low[:k] += unit * start.astype(np.uint64)
        self.range[:k] = unit * wide.astype(np.uint64)
        lanes: slice | np.ndarray = slice(0, k)
        while True:
            low, wide_now = self.low[lanes], self.range[lanes]
            settled = (low ^ (low + wide_now)) < _TOP
            going = np.flatnonzero(settled | (wide_now < _BOTTOM))
            if not len(going):
                return
            small = going[~settled[going]]
            lanes = self.row[lanes]
            self.range[lanes[small]] = (np.uint64(0) - low[small]) & _LOW
            lanes = lanes[going]
            shift(lanes)
            self.low[lanes] <<= _WORD
            self.range[lanes] <<= _WORD

    def unit(self, k: int) -> np.ndarray:
        return self.range[:k] // self.mixed.astype(np.uint64)


def _numbered(blocks: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of every block its different ids, ascending, and for each id its number among them."""
    out, top = [], max(int(b.max()) for b in blocks)
    if top >= _TABLE:
        return [np.unique(b, return_inverse=True) for b in blocks]
    # Ids of a vocabulary are marked in a table, which is faster than sorting them.
    marks, number = np.zeros(top + 1, bool), np.zeros(top + 1, np.int32)
    for block in blocks:
        marks[block] = True
        different = np.flatnonzero(marks)
        marks[different] = False
        number[different] = np.arange(len(different), dtype=np.int32)
        out.append((different, number[block]))
    return out


def _packed(steps: bytes) -> bytes:
    """Deflated with a small window: a list of ids is short, and setting up a large one would take longer."""
    deflate = zlib.compressobj(1, zlib.DEFLATED, 12, 5)
    return deflate.compress(steps) + deflate.flush()


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Every block of at least one id as a head, its different ids and its words."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    found = _numbered([blocks[i] for i in order])
    lengths = np.array([len(blocks[i]) for i in order])
    lanes = _Lanes(np.array([len(u) for u, _ in found]), lengths)
    numbers = np.zeros((int(lengths[0]), lanes.n), np.int64)
    for j, (_, inverse) in enumerate(found):
        numbers[: len(inverse), j] = inverse
    words = np.zeros((lanes.n, 2 * int(lengths[0]) + 8), np.uint16)
    used = np.zeros(lanes.n, np.int64)

    def shift(rows: np.ndarray) -> None:
        words[rows, used[rows]] = self_low[rows] >> np.uint64(48)
        used[rows] += 1

    self_low = lanes.low
    for t in range(len(numbers)):
        k = lanes.alive(t)
        if t and t % EPOCH == 0:
            lanes.renew(k)
        s = numbers[t, :k]
        lanes.predict(k)
        lanes.narrow(lanes.unit(k), *lanes.interval(s, k), k, shift)
        lanes.learn(s, k)
    for _ in range(4):
        shift(lanes.row)
        lanes.low <<= _WORD
    out = [b""] * len(blocks)
    for j, i in enumerate(order):
        ids = found[j][0].astype("<u4")
        body = words[j, : used[j]].astype("<u2").tobytes()
        steps = np.diff(ids, prepend=ids.dtype.type(0)).astype("<u4").tobytes()
        packed = _packed(steps)
        check = zlib.crc32(blocks[i].astype("<u4").tobytes())
        out[i] = _HEAD.pack(lengths[j], len(ids), len(packed), len(body), check) + packed + body
    return out


def decode_blocks(blocks: list[bytes]) -> list[np.ndarray]:
    """The ids of every block; a block whose checksum is wrong raises."""
    heads = [_HEAD.unpack_from(b) for b in blocks]
    order = sorted(range(len(blocks)), key=lambda i: -heads[i][0])
    lengths = np.array([heads[i][0] for i in order])
    lanes = _Lanes(np.array([heads[i][1] for i in order]), lengths)
    words = np.zeros((lanes.n, max(heads[i][3] for i in order) // 2 + 8), np.uint64)
    ids = []
    for j, i in enumerate(order):
        _, _, packed, body, _ = heads[i]
        steps = np.frombuffer(zlib.decompress(blocks[i][_HEAD.size : _HEAD.size + packed]), "<u4")
        ids.append(np.cumsum(steps, dtype=np.uint32))
        words[j, : body // 2] = np.frombuffer(blocks[i], "<u2", body // 2, _HEAD.size + packed)
    used = np.full(lanes.n, 4)
    code = np.zeros(lanes.n, np.uint64)
    for w in range(4):
        code = (code << _WORD) | words[:, w]

    def shift(rows: np.ndarray) -> None:
        code[rows] = (code[rows] << _WORD) | words[rows, used[rows]]
        used[rows] += 1

    numbers = np.zeros((int(lengths[0]), lanes.n), np.int32)
    for t in range(len(numbers)):
        k = lanes.alive(t)
        if t and t % EPOCH == 0:
            lanes.renew(k)
        lanes.predict(k)
        unit = lanes.unit(k)
        v = np.minimum((code[:k] - lanes.low[:k]) // unit, lanes.mixed.astype(np.uint64) - np.uint64(1)).astype(np.int32)
        s = lanes.find(v, k)
        lanes.narrow(unit, *lanes.interval(s, k), k, shift)
        lanes.learn(s, k)
        numbers[t, :k] = s
    out = [np.zeros(0, np.uint32)] * len(blocks)
    for j, i in enumerate(order):
        out[i] = ids[j][numbers[: lengths[j], j]]
        if zlib.crc32(out[i].astype("<u4").tobytes()) != heads[i][4]:
            raise ValueError("a block's checksum is wrong")
    return out


# Files


class IdFile:
    """A file being written."""

    def __init__(self, folder: str):
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        self.name = attempt_name("ids")
        self.out = store.open_output_stream(f"{root}/{self.name}")
        self.out.write(MAGIC)
        self.place, self.ids, self.docs = len(MAGIC), 0, 0
        self.waiting: list[np.ndarray] = []
        self.waits = 0
        self.table: list[bytes] = []
        self.sizes: list[int] = []

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> None:
        for doc, count in zip(doc_ids, counts):
            self.table.append(struct.pack("<?qq", doc is not None, doc or 0, count))
        self.docs += len(counts)
        self.ids += len(ids)
        self.waiting.append(ids)
        self.waits += len(ids)
        if self.waits >= LANES * BLOCK_IDS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        cut = len(ids) if last else len(ids) // BLOCK_IDS * BLOCK_IDS
        blocks = [ids[i : min(i + BLOCK_IDS, cut)] for i in range(0, cut, BLOCK_IDS)]
        for i in range(0, len(blocks), LANES):
            for block in encode_blocks(blocks[i : i + LANES]):
                self.out.write(block)
                self.sizes.append(len(block))
        self.waiting, self.waits = [ids[cut:]], len(ids) - cut

    def close(self) -> tuple[str, int, int]:
        self._flush(True)
        table = zlib.compress(b"".join(self.table), 1)
        index = np.array(self.sizes, "<u4").tobytes()
        self.out.write(table + index + _FOOT.pack(len(table), len(index), self.ids, MAGIC))
        self.out.close()
        return self.name, self.docs, self.ids


def read_ids(folder: str, name: str) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
    """Every document's id, its number of ids, and the ids in pieces, which have to be taken before the next one."""
    store, root = filesystem(folder)
    with store.open_input_file(f"{root}/{name}") as source:
        size = source.size()
        foot = _FOOT.unpack(source.read_at(_FOOT.size, size - _FOOT.size))
        if foot[3] != MAGIC or source.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{name} is not a file of ids")
        at = size - _FOOT.size - foot[1]
        sizes = np.frombuffer(source.read_at(foot[1], at), "<u4").tolist()
        table = zlib.decompress(source.read_at(foot[0], at - foot[0]))
        pieces = _pieces(source, sizes)
        rest = np.zeros(0, np.uint32)

        def take(count: int) -> Iterator[np.ndarray]:
            nonlocal rest
            while count:
                if not len(rest):
                    rest = next(pieces)
                piece, rest = rest[:count], rest[count:]
                count -= len(piece)
                yield piece

        for known, doc, count in struct.iter_unpack("<?qq", table):
            yield doc if known else None, count, take(count)


def _pieces(source, sizes: list[int]) -> Iterator[np.ndarray]:
    source.seek(len(MAGIC))
    for i in range(0, len(sizes), LANES):
        yield from decode_blocks([source.read(n) for n in sizes[i : i + LANES]])


_MANIFEST = "part int, number int, file string, docs bigint, ids bigint"


def write_ids(
    docs: DataFrame, folder: str, path: str, end_id: int = 0, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode texts, end each with ``end_id``, write them in ascending order of ids, and return the manifest."""
    ranged = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    ranged = ranged.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, file, done = TaskContext.get().partitionId(), 0, None, []
        for batch in slices(batches, "text"):
            file = file or IdFile(folder)
            ids, counts = codec(path).encode(texts_of(batch.column("text")))
            ends = np.cumsum(counts)
            file.add(batch.column("id").to_pylist(), np.insert(ids, ends, end_id).astype(np.uint32), counts + 1)
            if file.ids >= FILE_IDS or file.docs >= FILE_DOCS:
                done.append((part, number, *file.close()))
                number, file = number + 1, None
        if file:
            done.append((part, number, *file.close()))
        if done:
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            names = [c.split()[0] for c in _MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

    return stage(ranged.mapInArrow(write, _MANIFEST), "ids-manifest")


def _found(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """From the files: ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32``.

    ``start`` counts the ids before a document. Only the manifest, one row per file, is summed up in one task.
    """
    before = W.orderBy("part", "number").rowsBetween(W.unboundedPreceding, -1)
    placed = manifest.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    # As many parts as files: a manifest is tiny, and adaptive execution would join its rows to one task.
    files = placed.repartition(max(1, manifest.count()), F.col("file"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                rows = []
                for doc, count, pieces in read_ids(folder, file):
                    check = 0
                    for piece in pieces:
                        check = zlib.crc32(piece.astype("<u4").tobytes(), check)
                    rows.append((doc, start, count, check))
                    start += count
                    if len(rows) == _ROWS_OUT:
                        yield _found(rows)
                        rows = []
                if rows:
                    yield _found(rows)

    return files.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def write_and_read(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Write the ids of the documents to a new scratch folder and read them back."""
    folder = scratch_path(docs.sparkSession, "ids")
    return read_documents(write_ids(docs, folder, path, end_id), folder)
