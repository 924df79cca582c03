"""Line dedup by a segment-partition edit join.

Lines are what a text's line feeds leave, stripped of white space at both ends. Two lines are linked if at most
``tau`` edits of one character turn one into the other; a class is what copies and links connect, and its first
line is the one with the least document id and line number. ``tau`` is a number or a function of the longer line's
length, such as ``edits_allowed``. Lines of fewer than ``min_chars`` characters stand for themselves: with 1 these
are the blank ones alone. Whether short lines leave the texts is a choice of ``drop_repeated_lines`` only.

A line is cut into ``tau + 1`` segments. Of two linked lines the longer one contains a segment of the shorter one,
at a place that the segment's number and the two lengths narrow down to a few. Hashes of segments, with length and
number, are the index; hashes of the substrings at those places are the probes, and equal hashes make a candidate.

Where a function allows more than ``TAU`` edits, segments would need very many probes. These lines have as keys those
of their substrings of ``GRAM`` characters whose hashes are least, so many that ``tau`` edits can't touch all of them: an
edit touches what it lies in, so more than ``tau`` substrings that don't overlap are enough. Say the last hash that
one line took is not above the last one of the other. Then a key of the first line that edits leave whole is in the
second line, and below that line's last hash, so it is a key there as well. Two such lines are compared only if their
lengths and the places of the key differ by no more than the edits.

Candidates are verified on their texts, cut down to where they differ, with a bit-parallel edit distance in a band.

Scale: a task gives the keys of equal lines once. All keys are shuffled once, in order, and a pass over each partition
pairs the lines of a key. A key that more than ``JOINED_GROUP`` lines share and that would give many pairs is split by
a second key first. Lines found by segments are without the shared one again within ``tau`` edits, so
the segments of what is left of them are keys in turn; lines found by substrings are split by length and place. Lines
that still share both keys aren't joined with each other. What such keys connect is a unit, in which a line comes once
and not for each of its keys; it is dealt into blocks, and every pair of blocks is compared inside a task, so that only
links come out: which lines share a second key is a matrix of bits, then come lengths and counts of characters, of which
an edit changes two at most, and then the texts, thousands of pairs at a time. Where keys chain lines that mostly share
nothing, every key is a unit, and a pair is looked at where the least key that both lines have is. Texts are not shuffled with keys; those of candidates are fetched in a later pass, in which a bitmap of fixed size
keeps most other lines back. Stages are removed once they are read. What is left is work on pairs of
different lines that are alike: a family of n variants of one line is looked at n * n / 2 times.

Results for odd input: null and empty texts have one empty line. Repeated rows have the same lines, which are in
the same class; rows that share an id with another text count as lines of that document. A null id comes last.
A very long line is one line. An empty table gives no rows. Other columns don't matter.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.batches import free_name, ragged, slices
from tripmetrics.llm.components import components
from tripmetrics.sources import Stages, stage

TAU, MIN_CHARS = 2, 20
# One edit more for so many characters; characters of the keys of lines that may have more than TAU.
EDIT_CHARS, GRAM = 50, 16
_BASES = 0x6C078965, 0x2C1B3C6D
Edits = int | Callable[[int], int]
# Lines of a key up to which all of their pairs are candidates; of more lines, so many pairs a line, on average.
JOINED_GROUP, PAIRS_A_LINE = 32, 4
# Lines of a key that a task compares by length and place, and lines in a block.
HELD_LINES, BLOCK_LINES = 2048, 512
# Lines of blocks, about, for a task.
SPREAD_LINES = 5000
# How a key came about, and the largest number beside it that is told from larger ones.
_INDEX, _PROBE, _GRAM, _CLIP = 0, 1, 2, (1 << 20) - 1
# Lengths of a band differ by less; lines that are linked are in the same or in neighbouring bands.
_BAND = math.log(1.025)
_KEYS = "key bigint, id bigint, meta bigint"
# Bits of the map of wanted lines.
MAP_BITS = 1 << 23
_ROWS_OUT = 50_000
# Edits that are looked at for many pairs at once, characters of the shorter line, how many pairs and characters, and how
# few go one by one; kinds of characters that are told apart.
_WIDE, _LONG, _TOGETHER, _HELD_CHARS, _FEW, _KINDS = 31, 4096, 4096, 1 << 21, 96, 256
# Lines that keys connect are a unit up to so many times the pairs of its keys; pairs in a matrix, and pairs whose
# counts are compared at once.
WHOLE, _MATRIX, _COUNTED = 4, 1 << 18, 1 << 14
# Characters of lines whose keys are made at once.
_HASHED_CHARS = 1 << 16
_SEEN = 500_000
_BLANK = " \t\r\n\x0b\x0c"


# One line


def edits_allowed(size: int) -> int:
    """Edits between a line of ``size`` characters and one that is not longer: up to two, or 2% of the length."""
    return 0 if size < 8 else 1 if size < MIN_CHARS else max(TAU, size // EDIT_CHARS)


def _most(tau: Edits, size: int) -> int:
    return tau(size) if callable(tau) else tau


@functools.lru_cache(1 << 16)
def _taken(tau: Edits, size: int) -> list[int]:
    """Every number of edits, 0 apart, at which a line of ``size`` characters can be the shorter one of a pair."""
    longer = range(size, size + max(_most(tau, size), _most(tau, 2 * size + MIN_CHARS)) + 1)
    return sorted({_most(tau, n) for n in longer if n - size <= _most(tau, n)} - {0})


def _has_grams(tau: Edits, size: int) -> bool:
    """Whether a line of ``size`` characters can be in a pair that is found by grams."""
    return callable(tau) and _taken(tau, size)[-1:] > [TAU]



def _by_grams(tau: Edits, size: int) -> bool:
    return callable(tau) and _most(tau, size) > TAU


def _limit(tau: Edits, size: int) -> int:
    """Edits of any pair that a line of ``size`` characters is in."""
    return max(_taken(tau, size), default=0)


def _hashes(lines: list[str], base: int) -> np.ndarray:
    """Of the lines put together, a hash of the ``GRAM`` characters from every place on."""
    h = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    h = (h + np.uint32(1)) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    have = 1
    while have < GRAM:
        h = h[: len(h) - have] * np.uint32(pow(base, have, 1 << 32)) + h[have:]
        have *= 2
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h ^= h >> np.uint32(shift)
        h *= np.uint32(factor)
    return h ^ h >> np.uint32(16)


def grams(lines: list[str], needs: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, the number of the line of each, and the first and last place of the key in the line.

    They are the least hashes of a line, as many as it takes to have ``needs`` of them that don't overlap. A key has two
    hashes; the first decides.
    """
    sizes = np.array([len(line) for line in lines], np.int64)
    h, more = (_hashes(lines, base) for base in _BASES)
    starts = np.cumsum(sizes) - sizes
    have = sizes - (GRAM - 1)
    need = np.array(needs, np.float64)
    # About so many are needed; of lines for which they aren't enough, half as many again are taken.
    share = np.minimum(1.0, 1.05 * need / np.maximum(1.0, have - need * GRAM))
    todo, keys, of, places = np.arange(len(lines)), [], [], []
    while len(todo):
        at = ragged(starts[todo], have[todo])
        line = np.repeat(todo, have[todo])
        # A share of 1 takes all of them.
        bound = np.minimum(share * 2.0**32, 2.0**32 - 1).astype(np.uint32)
        chosen = np.flatnonzero(h[at] <= bound[line])
        at, line = at[chosen], line[chosen]
        place = at - starts[line]
        apart, end, last = dict.fromkeys(todo.tolist(), 0), 0, -1
        for k, p in zip(line.tolist(), place.tolist()):
            if k != last or p >= end:
                apart[k] += 1
                last, end = k, p + GRAM
        enough = np.array([apart[k] >= needs[k] or share[k] >= 1 for k in todo.tolist()])
        done = np.isin(line, todo[enough])
        keys.append(h[at[done]].astype(np.uint64) << np.uint64(32) | more[at[done]])
        of.append(line[done])
        places.append(place[done])
        todo = todo[~enough]
        share[todo] = np.minimum(1.0, 1.5 * share[todo])
    key, line, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, of, places))
    order = np.lexsort((place, key, line))
    key, line, place = key[order], line[order], place[order]
    new = np.ones(len(key) + 1, bool)
    new[1:-1] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])
    first, after = np.flatnonzero(new)[:-1], np.flatnonzero(new)[1:]
    return key[first].astype(np.uint64).view(np.int64), line[first], place[first], place[after - 1]


def segments(size: int, tau: int = TAU) -> list[tuple[int, int]]:
    """Start and length of ``tau + 1`` segments of nearly equal length; the last ones are longer by one."""
    short, longer = divmod(size, tau + 1)
    out, start = [], 0
    for i in range(tau + 1):
        n = short + (i > tau - longer)
        out.append((start, n))
        start += n
    return out


def places(size: int, other: int, tau: int = TAU) -> list[tuple[int, int, int]]:
    """Segment number, start and length of the substrings of a line that can equal a segment of one of ``other``.

    ``other <= size``. Edits to the left of a segment and to its right are both bounded by its number.
    """
    more, out = size - other, []
    for i, (p, n) in enumerate(segments(other, tau)):
        low = max(p - i, p + more - (tau - i), 0)
        high = min(p + i, p + more + (tau - i), size - n)
        out += [(i, start, n) for start in range(low, high + 1)]
    return out


def within(a: str, b: str, tau: int = TAU) -> bool:
    """Whether ``tau`` edits suffice: bit-parallel, one word of ``2 tau + 1`` diagonals for each number of edits."""
    if abs(len(a) - len(b)) > tau:
        return False
    if a == b:
        return True
    limit, start = min(len(a), len(b)), 0
    # Halving finds the first difference with few comparisons of long slices.
    step = limit
    while step:
        if a[start : start + step] == b[start : start + step] and start + step <= limit:
            start += step
        else:
            step //= 2
    a, b = a[start:], b[start:]
    same, most = 0, min(len(a), len(b))
    while same < most and a[-1 - same] == b[-1 - same]:
        same += 1
    a, b = a[: len(a) - same], b[: len(b) - same]
    if not a or not b:
        return max(len(a), len(b)) <= tau
    if tau <= TAU:
        return _banded(a, b, tau)
    # Work on bits grows with the length, work on diagonals with the square of the edits.
    return _by_bits(a, b, tau) if len(a) < 2 * tau * tau else _by_diagonals(a, b, tau)


def _banded(a: str, b: str, tau: int) -> bool:
    """Cells of a row that ``e`` edits reach are the bits of word ``e``; bit ``d`` is the diagonal ``d - tau``."""
    width = 2 * tau + 1
    full = (1 << width) - 1
    where: dict[str, int] = {}
    for j, c in enumerate(b):
        where[c] = where.get(c, 0) | 1 << (j + tau)
    # Row 0: the first e characters of b are inserted.
    rows = [((1 << (e + 1)) - 1) << tau & full for e in range(tau + 1)]
    for i, c in enumerate(a):
        # Bit d says whether b[i + d - tau] is c.
        equal = where.get(c, 0) >> i & full
        fresh, before = [], 0
        for e, word in enumerate(rows):
            now = word & equal
            if e:
                # A substitution keeps the diagonal, a deletion of c goes one down, an insertion one up.
                now |= rows[e - 1] | rows[e - 1] >> 1
                now |= before << 1 & full
            fresh.append(now)
            before = now
        rows = fresh
        if not rows[-1]:
            return False
    end = len(b) - len(a) + tau
    return 0 <= end < width and bool(rows[-1] >> end & 1)


def _by_bits(a: str, b: str, tau: int) -> bool:
    """Vertical differences of a column in a band, which moves down a row with each character of the shorter line.

    ``_together`` is the same for many pairs. Paths outside the band have more than ``tau`` edits.
    """
    if len(a) < len(b):
        a, b = b, a
    gap = len(a) - len(b)
    half = (tau - gap) // 2
    top, goal = 2 * half + gap, half + gap
    full = (2 << top) - 1
    where: dict[str, int] = {}
    for j, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << (j + half)
    below, above, distance = full >> half << half, 0, gap
    for i, c in enumerate(b):
        x = where.get(c, 0) >> i & full
        diagonal = ((x & below) + below ^ below | x | above) & full
        plus = above | full & ~(diagonal | below)
        minus = diagonal & below
        if not diagonal >> goal & 1:
            distance += 1
            if distance > tau:
                return False
        moved = diagonal >> 1
        below, above = minus | full & ~(moved | plus), moved & plus
    return True


def _alike(a: str, b: str, i: int, j: int) -> int:
    """How many characters from ``i`` on equal those from ``j`` on."""
    n, step, most = 0, 16, min(len(a) - i, len(b) - j)
    while n < most:
        if a[i + n : i + n + step] == b[j + n : j + n + step]:
            n += step
            step *= 2
        elif step == 1:
            break
        else:
            step //= 2
    return min(n, most)


def _by_diagonals(a: str, b: str, tau: int) -> bool:
    """How far each number of edits gets on each diagonal ``j - i``: work grows with the edits, not the length."""
    goal = len(b) - len(a)
    reach = {0: _alike(a, b, 0, 0)}
    for e in range(1, tau + 1):
        fresh = {}
        for d in range(max(-e, goal - tau + e), min(e, goal + tau - e) + 1):
            i = min(max(reach.get(d, -2) + 1, reach.get(d + 1, -2) + 1, reach.get(d - 1, -2)), len(a), len(b) - d)
            if i < 0 or i + d < 0:
                continue
            i += _alike(a, b, i, i + d)
            if d == goal and i == len(a):
                return True
            fresh[d] = i
        reach = fresh
    return False


def _lines(text: str | None) -> list[str]:
    return [line.strip(_BLANK) for line in (text or "").split("\n")]


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def _id(wide: bytes) -> int:
    return _signed(xxhash.xxh3_64_intdigest(wide))


def _key(wide: bytes, i: int, start: int, n: int, size: int, tau: int) -> int:
    """Of a segment or substring; number, length of the line and edits are the seed."""
    return xxhash.xxh3_64_intdigest(wide[4 * start : 4 * (start + n)], _seed(i, size, tau))


def _seed(i: int, size: int, tau: int) -> int:
    return (size * 64 + i) * 64 + tau


def _cuts(tau: Edits, size: int) -> list[tuple[int, int, int, int]]:
    """Edits, number, start and length of the segments of a line."""
    edits = [t for t in _taken(tau, size) if not callable(tau) or t <= TAU]
    return [(t, i, p, n) for t in edits for i, (p, n) in enumerate(segments(size, t))]


def _asks(tau: Edits, size: int, min_chars: int) -> list[tuple[int, int, int, int, int]]:
    """Number, start, length, the other line's length and edits of the substrings that can equal a segment of it.

    Substrings that are the line's own segments are left out: lines that share those share index keys.
    """
    t = 0 if _by_grams(tau, size) else _most(tau, size)
    return [
        (i, start, n, other, t)
        for other in range(max(size - t, min_chars), size + 1 if t else 0)
        for i, start, n in places(size, other, t)
        if other < size or (start, n) != segments(size, t)[i]
    ]


def _meta(kind: int, size, first=0, last=0):
    """How a key came about, the line's length, and the key's first and last place, in one number."""
    clip = lambda x: np.minimum(x, _CLIP)
    return (kind << 60) + (clip(size) << 40) + (clip(first) << 20) + clip(last)


# Passes over documents


def find_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id``, ``line_no`` and two hashes ``h1``, ``h2`` of every line; short lines have none."""
    schema = "doc_id bigint, line_no int, h1 bigint, h2 bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            numbers, docs_of, ids, others = [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                lines = _lines(text)
                docs_of += [doc] * len(lines)
                numbers += range(len(lines))
                for line in lines:
                    if len(line) < min_chars:
                        ids.append(None)
                        others.append(None)
                        continue
                    wide = line.encode("utf-32-le", "surrogatepass")
                    ids.append(_id(wide))
                    others.append(_signed(xxhash.xxh64_intdigest(wide)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip((docs_of, numbers, ids, others), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "line_no", "h1", "h2"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def _batches(key: np.ndarray, own: np.ndarray, meta: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(key), _ROWS_OUT):
        columns = [pa.array(c[i : i + _ROWS_OUT], pa.int64()) for c in (key, own, meta)]
        yield pa.RecordBatch.from_arrays(columns, ["key", "id", "meta"])


def line_keys(docs: DataFrame, tau: Edits = TAU, min_chars: int = MIN_CHARS) -> DataFrame:
    """``key``, ``id`` and ``meta`` of the segments, probes and substrings of every line.

    A task gives a line that comes again and again once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, asks, limits, seen, digest = {}, {}, {}, set(), xxhash.xxh3_64_intdigest
        for batch in slices(batches, "text"):
            keys, counts, ids, metas = [], [], [], []
            long, needs, own_long = [], [], []
            for text in batch.column("text").to_pylist():
                for line in _lines(text):
                    size = len(line)
                    if size < min_chars:
                        continue
                    wide = line.encode("utf-32-le", "surrogatepass")
                    own = _id(wide)
                    if own in seen:
                        continue
                    seen.add(own)
                    if size not in cuts:
                        # Where each key begins and ends in the line's bytes, and its seed.
                        cuts[size] = [(4 * p, 4 * (p + n), _seed(i, size, t)) for t, i, p, n in _cuts(tau, size)]
                        asks[size] = [
                            (4 * p, 4 * (p + n), _seed(i, other, t)) for i, p, n, other, t in _asks(tau, size, min_chars)
                        ]
                        limits[size] = _limit(tau, size) if _has_grams(tau, size) else 0
                    for kind, spots in ((_INDEX, cuts[size]), (_PROBE, asks[size])):
                        found = [digest(wide[p:q], seed) for p, q, seed in spots]
                        if found:
                            keys += found
                            counts.append(len(found))
                            ids.append(own)
                            metas.append(kind << 60 | min(size, _CLIP) << 40)
                    if limits[size]:
                        long.append(line)
                        needs.append(limits[size] + 1)
                        own_long.append(own)
            if len(seen) > _SEEN:
                seen.clear()
            if keys:
                times = np.array(counts)
                key = np.array(keys, np.uint64).view(np.int64)
                yield from _batches(key, np.repeat(np.array(ids, np.int64), times), np.repeat(np.array(metas, np.int64), times))
            # As many lines at once as a processor's cache holds.
            chars = np.cumsum([len(line) for line in long]) // _HASHED_CHARS
            for start, stop in zip(*(np.searchsorted(chars, np.unique(chars), side) for side in ("left", "right"))):
                key, of, first, last = grams(long[start:stop], needs[start:stop])
                size = np.array([len(line) for line in long[start:stop]], np.int64)[of]
                yield from _batches(key, np.array(own_long[start:stop], np.int64)[of], _meta(_GRAM, size, first, last))

    return docs.select("text").mapInArrow(run, _KEYS)


def _unpacked(meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return meta >> 60, meta >> 40 & _CLIP, meta >> 20 & _CLIP, meta & _CLIP


class _Meeting:
    """Pairs the lines of a key; ``edits`` is a table of the limits of line lengths, filled as they come."""

    def __init__(self, tau: Edits, joined: int, held: int, pairs_a_line: int):
        self.tau, self.joined, self.held, self.pairs_a_line = tau, joined, held, pairs_a_line
        self.edits: dict[int, int] = {_CLIP: 1 << 40}

    def limits(self, sizes: np.ndarray) -> np.ndarray:
        found, at = np.unique(sizes, return_inverse=True)
        for size in found.tolist():
            if size not in self.edits:
                self.edits[size] = _limit(self.tau, size)
        return np.array([self.edits[s] for s in found.tolist()], np.int64)[at]

    def fits(self, meta: np.ndarray, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Whether rows ``i`` and ``j`` of one key can be linked."""
        kind, size, first, last = _unpacked(meta)
        edits = np.minimum(limit[i], limit[j])
        near = (np.abs(size[i] - size[j]) <= edits) & (first[i] - last[j] <= edits) & (first[j] - last[i] <= edits)
        both = (kind[i] == _GRAM) & (kind[j] == _GRAM) & near
        return both | ((kind[i] != _GRAM) & (kind[j] != _GRAM) & ((kind[i] == _INDEX) | (kind[j] == _INDEX)))

    def groups(self, key: np.ndarray, own: np.ndarray, meta: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Of whole groups in the order of key, id and meta."""
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
        key, own, meta = key[new], own[new], meta[new]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(starts, len(key)))
        several = np.repeat(count > 1, count)
        key, own, meta, count = key[several], own[several], meta[several], count[count > 1]
        if not len(key):
            return
        limit = self.limits(_unpacked(meta)[1])
        starts = np.cumsum(count) - count
        small = count <= self.joined
        behind = np.repeat(np.where(small, starts + count, 0), count) - np.arange(len(key))
        left, right = [], []
        # In small groups, every row with the one d rows after it.
        at, d = np.flatnonzero(behind > 1), 1
        while len(at):
            good = self.fits(meta, at, at + d, limit)
            left.append(at[good])
            right.append(at[good] + d)
            d += 1
            at = at[behind[at] > d]
        for start, n in zip(starts[~small].tolist(), count[~small].tolist()):
            i, j = np.triu_indices(n, 1)
            good = self.fits(meta[start : start + n], i, j, limit[start : start + n])
            i, j = i[good] + start, j[good] + start
            if len(i) > self.pairs_a_line * n:
                rows = np.unique(np.concatenate([i, j]))
                yield _met(key[rows], own[rows], meta[rows], np.full(len(rows), own[rows[0]]))
            else:
                left.append(i)
                right.append(j)
        if left:
            a, b = own[np.concatenate(left)], own[np.concatenate(right)]
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield _met(None, pairs[0], None, pairs[1])


def _met(key: np.ndarray | None, a: np.ndarray, meta: np.ndarray | None, b: np.ndarray) -> pa.RecordBatch:
    """Pairs ``a``, ``b``, or rows of a key that has yet to be split, ``b`` being the same line for all of them."""
    columns = [pa.nulls(len(a), pa.int64()) if c is None else pa.array(c, pa.int64()) for c in (key, a, b, meta)]
    return pa.RecordBatch.from_arrays(columns, ["key", "a", "b", "meta"])


def _meet(rows: DataFrame, tau: Edits) -> DataFrame:
    """``a`` and ``b`` of candidate pairs, and with a ``key`` and ``meta`` the lines of keys that have yet to be split.

    There ``b`` is one line of the key.
    """
    meeting = (tau, JOINED_GROUP, max(HELD_LINES, JOINED_GROUP), PAIRS_A_LINE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Meeting(*meeting)
        held, hot, one = [np.zeros(0, np.int64)] * 3, None, None
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            if hot is not None:
                # The rest of a key of which too many rows have come; they pass as they are.
                n = int(np.searchsorted(columns[0], hot, "right"))
                if n:
                    yield _met(*(c[:n] for c in columns), np.full(n, one))
                columns = [c[n:] for c in columns]
                if not len(columns[0]):
                    continue
                hot = None
            held = [np.concatenate(c) for c in zip(held, columns)]
            if not len(held[0]):
                continue
            last = int(np.searchsorted(held[0], held[0][-1], "left"))
            yield from own.groups(*(c[:last] for c in held))
            held = [c[last:] for c in held]
            new = np.concatenate([[True], held[1][1:] != held[1][:-1]])
            if new.sum() > own.held:
                hot, one = int(held[0][0]), int(held[1][0])
                yield _met(*(c[new] for c in held), np.full(int(new.sum()), one))
                held = [np.zeros(0, np.int64)] * 3
        yield from own.groups(*held)

    ordered = rows.repartition("key").sortWithinPartitions("key", "id", "meta")
    return ordered.mapInArrow(run, "key bigint, a bigint, b bigint, meta bigint")


class _Cells:
    """Second keys of lines that share a substring: by length and by the place of the substring.

    A line is in the band of its length and the one above it, and in every cell of a band that the places of the substring
    reach and the one behind. Lines whose lengths and places fit share a cell.
    """

    def __init__(self, tau: Edits):
        self.tau, self.widths = tau, {}
        # From this band on places aren't told apart, so that clipped numbers do no harm.
        self.top = int(math.log(_CLIP >> 1) / _BAND)

    def _width(self, band: int) -> int:
        if band not in self.widths:
            longest = math.ceil(math.exp((band + 1) * _BAND))
            self.widths[band] = _limit(self.tau, longest) + 1 if band < self.top else 1 << 40
        return self.widths[band]

    def names(self, key: np.ndarray, size: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Second keys, and the number of the row of each."""
        out, rows = [], []
        own = np.floor(np.log(np.maximum(size, 1)) / _BAND).astype(np.int64)
        for band in (own, own + 1):
            width = np.array([self._width(b) for b in band.tolist()], np.int64)
            low = first // width
            times = last // width + 2 - low
            row = np.repeat(np.arange(len(key)), times)
            name = key.view(np.uint64)[row] * np.uint64(0x9E3779B97F4A7C15)
            name = (name ^ band[row].astype(np.uint64) << np.uint64(32)) + ragged(low, times).astype(np.uint64)
            name = (name ^ name >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93)
            # The last bits say which cell it is.
            cell = (band[row] & 63) << 6 | ragged(low, times) & 63
            out.append(name.view(np.int64) & ~0xFFF | cell)
            rows.append(row)
        return np.concatenate(out), np.concatenate(rows)


def _split_grams(many: DataFrame, tau: Edits) -> DataFrame:
    """Keys of lines that share a substring, split by length and by the place of the substring."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _Cells(tau)
        for batch in batches:
            key, own, meta = (c.to_numpy() for c in batch.columns)
            _, size, first, last = _unpacked(meta)
            name, row = cells.names(key, size, first, last)
            yield from _batches(name, own[row], meta[row])

    return many.select("key", "id", "meta").mapInArrow(run, _KEYS)


def _segment_names(line: str, cuts: list, asks: list, only: tuple[int, int] | None = None) -> Iterator[tuple[int, int]]:
    """Kinds and second keys of a line that shares a segment: from the segments of what is left of it without that one.

    Of all its keys, or of ``only`` one, given with its kind.
    """
    wide, size = line.encode("utf-32-le", "surrogatepass"), len(line)
    shared = [(_INDEX, _signed(_key(wide, i, p, n, size, t)), p, n, size, t) for t, i, p, n in cuts]
    shared += [(_PROBE, _signed(_key(wide, i, p, n, other, t)), p, n, other, t) for i, p, n, other, t in asks]
    for kind, key, p, n, other, t in shared:
        if only and (kind, key) != only:
            continue
        rest = wide[: 4 * p] + wide[4 * (p + n) :]
        have, looked_for = len(rest) // 4, other - n
        own = segments(have, t) if kind == _INDEX else []
        spots = [(_INDEX, i, q, k) for i, (q, k) in enumerate(own)]
        spots += [(_PROBE, i, q, k) for i, q, k in places(have, looked_for, t) if not own or own[i] != (q, k)]
        for role, i, q, k in spots:
            seed = (key * 0x9E3779B97F4A7C15 + (looked_for * 64 + i) * 64 + t) & (1 << 64) - 1
            yield role, _signed(xxhash.xxh3_64_intdigest(rest[4 * q : 4 * (q + k)], seed))


def _split_segments(many: DataFrame, tau: Edits, min_chars: int) -> DataFrame:
    """Keys of lines that share a segment, from the segments of what is left of each without it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, asks = {}, {}
        for batch in batches:
            keys, ids, metas = [], [], []
            for key, own, meta, line in zip(*(c.to_pylist() for c in batch.columns)):
                size = len(line)
                if size not in cuts:
                    cuts[size], asks[size] = _cuts(tau, size), _asks(tau, size, min_chars)
                for role, name in _segment_names(line, cuts[size], asks[size], (meta >> 60, key)):
                    keys.append(name)
                    ids.append(own)
                    metas.append(role << 60 | min(size, _CLIP) << 40)
            yield from _batches(*(np.array(c, np.int64) for c in (keys, ids, metas)))

    return many.select("key", "id", "meta", "line").mapInArrow(run, _KEYS)


def _texts(docs: DataFrame, wanted: DataFrame, min_chars: int) -> DataFrame:
    """``h1``, ``h2`` and ``line`` of the lines whose ``h1`` is among the ids wanted, each once.

    The bitmap has a fixed number of bits: where very many lines are wanted it keeps fewer back, and the join,
    which decides, gets more rows.
    """
    at = F.pmod(F.col("id"), F.lit(MAP_BITS))
    words = wanted.select(at.alias("at")).groupBy(F.expr("cast(at div 64 AS int)").alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at % 64 AS int)))").alias("bits")
    )
    table = words.toArrow()
    bits = np.zeros(MAP_BITS // 64, np.int64)
    bits[table.column("w").to_numpy()] = table.column("bits").to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = sent.value
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            rows = []
            for text in batch.column("text").to_pylist():
                for line in _lines(text):
                    if len(line) < min_chars:
                        continue
                    wide = line.encode("utf-32-le", "surrogatepass")
                    own = _id(wide)
                    place = own % MAP_BITS
                    if int(marks[place >> 6]) >> (place & 63) & 1 and own not in seen:
                        seen.add(own)
                        rows.append((own, _signed(xxhash.xxh64_intdigest(wide)), line))
            if len(seen) > _SEEN:
                seen.clear()
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["h1", "h2", "line"])

    found = docs.select("text").mapInArrow(run, "h1 bigint, h2 bigint, line string")
    return found.join(wanted.withColumnRenamed("id", "h1"), "h1", "left_semi").dropDuplicates(["h1", "h2"])


# The join


def _pairs_of(df: DataFrame) -> DataFrame:
    return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _node(h1: Column, h2: Column) -> Column:
    """One text for both hashes of a line."""
    return F.concat(F.lpad(F.hex(h1), 16, "0"), F.lpad(F.hex(h2), 16, "0"))


def links(docs: DataFrame, into: Stages, tau: Edits = TAU, min_chars: int = MIN_CHARS) -> DataFrame:
    """``a``, ``b``: the linked pairs of different lines, each once, as texts of both hashes; a stage of ``into``."""
    with Stages(docs.sparkSession, "line-links") as own:
        met = own.write(_meet(line_keys(docs, tau, min_chars), tau), "met")
        is_gram = F.shiftright("meta", 60) == _GRAM
        many = met.where("key IS NOT NULL").select("key", F.col("a").alias("id"), "meta").distinct()
        many = own.write(many, "many")
        pairs = own.write(_pairs_of(met.where("key IS NULL")), "pairs", done=("met",))
        both = F.explode(F.array("a", "b")).alias("id")
        wanted = own.write(pairs.select(both).unionByName(many.select("id")).distinct(), "wanted")
        texts = own.write(_texts(docs, wanted, min_chars), "texts", done=("wanted",))

        # Lines of keys that many share meet again by a second key; those that share it as well are dealt into blocks.
        named = texts.select(F.col("h1").alias("id"), "line")
        split = _split_grams(many.where(is_gram), tau).unionByName(
            _split_segments(many.where(~is_gram).join(named, "id"), tau, min_chars)
        )
        met = own.write(_meet(split, tau), "met-again", done=("many",))
        hot = met.where("key IS NOT NULL").select("key", F.col("a").alias("id"), F.col("b").alias("first")).distinct()
        hot = own.write(hot, "hot")
        found = pairs.unionByName(met.where("key IS NULL").select("a", "b"))
        pairs = own.write(_pairs_of(found), "all-pairs", done=("pairs", "met-again"))

        a = texts.select(F.col("h1").alias("a"), _node("h1", "h2").alias("na"), F.col("line").alias("la"))
        b = texts.select(F.col("h1").alias("b"), _node("h1", "h2").alias("nb"), F.col("line").alias("lb"))
        verified = pairs.join(a, "a").join(b, "b").select("na", "nb", "la", "lb").mapInArrow(_verify(tau), "a string, b string")
        if n_hot := hot.count():
            blocks = own.write(_block_links(hot, n_hot, texts, tau, own), "block-links", done=("units",))
            verified = verified.unionByName(blocks)
        return into.write(_pairs_of(verified), "links")


def _units(hot: DataFrame, into: Stages) -> DataFrame:
    """``unit``, ``whole``, ``id`` and ``lines``: the lines that are compared with each other, and how many these are.

    ``hot`` has the ``id`` of the lines of each ``key``, each once, and ``first``, one of them. A unit is all that shared
    keys connect, so that a line is there once and not for each of its keys. Where this chains lines that mostly share
    nothing, every key is a unit of its own.
    """
    roots = components(hot.select(F.col("first").alias("a"), F.col("id").alias("b")), into)
    lines = hot.select("id").distinct().join(roots, F.col("id") == F.col("node"), "left")
    lines = into.write(lines.select("id", F.coalesce("root", "id").alias("root")), "hot-lines")
    keys = hot.groupBy("key", F.col("first").alias("id")).agg(F.count("*").alias("n"))
    keys = into.write(keys.join(lines, "id").select("key", "n", "root"), "hot-keys")
    by_key = keys.groupBy("root").agg(F.sum(F.expr("cast(n AS double) * n")).alias("by_key"))
    sizes = lines.groupBy("root").agg(F.count("*").alias("lines"))
    whole = F.expr(f"cast(lines AS double) * lines <= {WHOLE} * by_key").alias("whole")
    ways = into.write(sizes.join(by_key, "root").select("root", "lines", whole), "hot-ways")
    wholes = lines.join(ways.where("whole"), "root")
    apart = hot.join(keys.join(ways.where("NOT whole").select("root"), "root", "left_semi"), "key")
    return wholes.select(F.col("root").alias("unit"), F.lit(True).alias("whole"), "id", "lines").unionByName(
        apart.select(F.col("key").alias("unit"), F.lit(False).alias("whole"), "id", F.col("n").alias("lines"))
    )


def _block_links(hot: DataFrame, n_hot: int, texts: DataFrame, tau: Edits, into: Stages) -> DataFrame:
    """Links ``a``, ``b`` of lines that share both keys with very many others; ``n_hot`` rows say so."""
    dealt = into.write(_units(hot, into), "units", done=tuple(into.live("hot-") + into.live("components-")))
    dealt = dealt.withColumn("blocks", F.ceil(F.col("lines") / BLOCK_LINES).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    lines = texts.select(F.col("h1").alias("id"), _node("h1", "h2").alias("node"), "line")
    cells = hot.groupBy("id").agg(F.sort_array(F.collect_set("key")).alias("cells"))
    dealt = dealt.join(lines.join(cells, "id"), "id")
    # A line meets its own block and each other one, the lower number first.
    meets = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    names = ("unit", "whole", "node", "line", "cells", "own")
    x, y = F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")
    # Blocks are small and take long, so they are spread by number and not by size.
    most = int(hot.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = min(most, n_hot // SPREAD_LINES + 1)
    dealt = dealt.select(*names, meets).select(*names, x, y).repartition(spread, "unit", "whole", "x", "y")
    return dealt.groupBy("unit", "whole", "x", "y").applyInPandas(_compare_block(tau), "a string, b string")


def _marks(cells: list[np.ndarray]) -> np.ndarray:
    """For each line, bits of the second keys that it has and another line as well."""
    of = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
    found, at, times = np.unique(np.concatenate(cells), return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    kept = times[at] > 1
    of, bit = of[kept], number[at[kept]]
    marks = np.zeros((int((times > 1).sum()) // 64 + 1, len(cells)), np.uint64)
    np.bitwise_or.at(marks, (bit >> 6, of), np.uint64(1) << (bit & 63).astype(np.uint64))
    return marks


def _compare_block(tau: Edits):
    """Links of two blocks of a unit: of lines that share a second key, or that share it and none that is less."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        unit, whole, x, y = (rows[c].iloc[0] for c in ("unit", "whole", "x", "y"))
        rows = rows.sort_values("node").drop_duplicates("node")
        nodes, lines, own = rows["node"].to_numpy(), rows["line"].tolist(), rows["own"].to_numpy()
        cells = [np.asarray(c, np.int64) for c in rows["cells"]]
        marks = _marks(cells if whole else [c[c < unit] for c in cells])
        size = np.array([len(line) for line in lines], np.int32)
        edits = np.array([_most(tau, n) for n in size.tolist()], np.int32)
        left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        step = max(1, _MATRIX // max(1, len(right)))
        for k in range(0, len(left), step):
            i = left[k : k + step, None]
            gap = size[i] - size[right]
            near = np.abs(gap) <= np.where(gap >= 0, edits[i], edits[right])
            if x == y:
                near &= i < right
            share = np.zeros(near.shape, np.uint64)
            for word in marks:
                share |= word[i] & word[right]
            i, j = np.nonzero(near & ((share != 0) == bool(whole)))
            a.append(left[k + i])
            b.append(right[j])
        a, b = np.concatenate(a), np.concatenate(b)
        good = _linked(lines, a, b, tau)
        return pd.DataFrame({"a": nodes[a[good]].astype(str), "b": nodes[b[good]].astype(str)})

    return run


def _counts(lines: list[str]) -> np.ndarray:
    """How often characters of each of 64 kinds occur in every line, up to 255 times."""
    out = np.zeros((len(lines), 64), np.uint8)
    for row, line in zip(out, lines):
        points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
        row[:] = np.minimum(np.bincount(points % 64, minlength=64), 255)
    return out


def _triples_apart(lines: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By how much counts of three characters in a row differ, of 4096 kinds; an edit changes six of them at most."""
    out = np.zeros(len(a), np.int64)
    for k in range(0, len(a), 1000):
        some, at = np.unique(np.concatenate([a[k : k + 1000], b[k : k + 1000]]), return_inverse=True)
        counts = np.zeros((len(some), 4096), np.uint16)
        for row, i in zip(counts, some.tolist()):
            points = np.frombuffer(lines[i].encode("utf-32-le", "surrogatepass"), np.uint32)
            kinds = (points[:-2] * np.uint32(0x9E3779B1) + points[1:-1]) * np.uint32(0x85EBCA6B) + points[2:]
            row[:] = np.minimum(np.bincount(kinds * np.uint32(0xC2B2AE35) >> np.uint32(20), minlength=4096), 65535)
        for n, (i, j) in enumerate(zip(*np.split(at, 2))):
            out[k + n] = np.abs(counts[i].astype(np.int32) - counts[j]).sum()
    return out


def _counts_apart(counts: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.zeros(len(i), np.int64)
    for k in range(0, len(i), _COUNTED):
        one, other = counts[i[k : k + _COUNTED]], counts[j[k : k + _COUNTED]]
        out[k : k + _COUNTED] = (np.maximum(one, other) - np.minimum(one, other)).sum(axis=1, dtype=np.int32)
    return out


def _linked(lines: list[str], a: np.ndarray, b: np.ndarray, tau: Edits) -> np.ndarray:
    """The numbers of the pairs of lines within their edits; most are looked at together."""
    size = np.array([len(line) for line in lines], np.int64)
    edits = np.array([_most(tau, n) for n in size.tolist()], np.int64)
    limit = np.where(size[a] >= size[b], edits[a], edits[b])
    good = np.zeros(len(a), bool)
    gap, short = np.abs(size[a] - size[b]), np.minimum(size[a], size[b])
    # An edit changes two of the counts at most.
    near = (gap <= limit) & (_counts_apart(_counts(lines), a, b) <= 2 * limit)
    together = (limit + gap <= 2 * _WIDE) & (short <= _LONG)
    many = np.flatnonzero(near & together)
    apart = np.flatnonzero(near & ~together)
    apart = apart[_triples_apart(lines, a[apart], b[apart]) <= 6 * limit[apart]].tolist()
    many = many[np.argsort(short[many], kind="stable")]
    while len(many):
        count = min(_TOGETHER, max(_FEW, _HELD_CHARS // max(1, int(short[many[0]]))))
        part, many = many[:count], many[count:]
        if len(part) < _FEW:
            apart += part.tolist()
            continue
        good[part], sure = _together(lines, a[part], b[part], limit[part])
        if not sure:
            apart += part[good[part]].tolist()
    for i in apart:
        good[i] = within(lines[a[i]], lines[b[i]], int(limit[i]))
    return np.flatnonzero(good)


def _verify(tau: Edits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb, la, lb = (c.to_pylist() for c in batch.columns)
            number: dict[str, int] = {}
            a, b = (np.array([number.setdefault(x, len(number)) for x in side], np.int64) for side in (la, lb))
            good = _linked(list(number), a, b, tau).tolist()
            sides = ([n[i] for i in good] for n in (na, nb))
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.string()) for s in sides], ["a", "b"])

    return run


def _can_be_within(a: list[str], b: list[str], edits: list[int]) -> np.ndarray:
    """For many pairs at once, whether their edit distance can be at most ``edits`` (up to ``_WIDE``).

    Characters are compared by 16 bits or less, so a pair within its edits is never ruled out.
    """
    n = len(a)
    return _together(a + b, np.arange(n), np.arange(n, 2 * n), np.array(edits, np.int64))[0]


def _together(lines: list[str], a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, bool]:
    """For pairs of lines, whether their edit distance is at most ``limit``, and if that is certain.

    Bit-parallel along the diagonal: one 64-bit number a pair has the vertical differences of a column in a band of 64 rows,
    and moves down a row with each character of the shorter line. A path outside the band has more edits than the limit
    where that and the difference of lengths are ``2 * _WIDE`` together, or less.
    The last cell's diagonal is followed: it never falls, so a pair is given up when it is above its limit there. Where
    a character of the shorter line stands in the band of the longer one is the same for all pairs of that line, and kept in
    a table of lines and characters. With very many different characters some share a place in it, and nothing is certain.
    """
    size = np.array([len(line) for line in lines], np.int64)
    swap = size[a] < size[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    order = np.argsort(-size[b], kind="stable")
    first, a = np.unique(a[order], return_inverse=True)
    second, b = np.unique(b[order], return_inverse=True)
    points = [np.frombuffer(lines[i].encode("utf-32-le", "surrogatepass"), np.uint32) for i in (*first.tolist(), *second.tolist())]
    every = np.concatenate(points)
    narrow = np.minimum(every & 0xFFFF, 0xFFFE)
    sure = not len(every) or int(every.max()) < 0xFFFE
    found = np.flatnonzero(np.bincount(narrow, minlength=1))
    kinds = min(len(found), _KINDS)
    sure &= kinds == len(found)
    code = np.zeros(1 << 16, np.int64)
    code[found] = np.arange(len(found)) % max(1, kinds)
    codes, starts = code[narrow], np.cumsum([0, *(len(p) for p in points)])

    n, m = size[first][a], size[second][b]
    columns = int(m.max(initial=0))
    # Of shorter lines by place; behind a line's end come characters that no pair looks at.
    texts = np.zeros((columns, len(second)), np.int64)
    for k, i in enumerate(range(len(first), len(points))):
        texts[: len(points[i]), k] = codes[starts[i] : starts[i + 1]]
    # Of longer lines, the characters that come into the band with each column; the last kind is none.
    entering = np.full((columns + 64, len(first)), kinds, np.int64)
    for k in range(len(first)):
        own = codes[starts[k] : starts[k + 1]][: columns + 64]
        entering[: len(own), k] = own
    rows = np.arange(len(first)) * (kinds + 1)
    entering += rows
    table = np.zeros(len(first) * (kinds + 1), np.uint64)
    one, half = np.uint64(1), 32
    for t in range(half):
        table[entering[t]] |= one << np.uint64(half + t)
    top = one << np.uint64(63)

    base, limit = rows[a], limit[order]
    goal, distance = np.minimum(half + n - m, 63).astype(np.uint64), n - m
    below = np.full(len(a), (1 << 64) - (1 << half), np.uint64)
    above = np.zeros(len(a), np.uint64)
    hits = np.zeros(len(a), np.uint64)
    rows_of, near = np.arange(len(a)), np.zeros(len(a), bool)
    at, x, diagonal, plus = np.zeros(len(a), np.int64), *(np.zeros(len(a), np.uint64) for _ in range(3))
    for column in range(columns + 1):
        # Pairs are in order of their shorter lines, so the finished ones are the last.
        live = int(np.searchsorted(-m, -column, "left"))
        keep = slice(0, live)
        if live < len(m):
            near[order[rows_of[live:]]] = distance[live:] + m[live:] - hits[live:].astype(np.int64) <= limit[live:]
        if column % 16 == 0 and live:
            hopeful = np.flatnonzero(distance[:live] + column - hits[:live].astype(np.int64) <= limit[:live])
            keep = hopeful if len(hopeful) < 0.9 * live else keep
            live = len(hopeful) if keep is hopeful else live
        if live < len(m):
            m, limit, base, goal, distance, below, above, hits, rows_of, b = (
                v[keep] for v in (m, limit, base, goal, distance, below, above, hits, rows_of, b)
            )
            at, x, diagonal, plus = (v[:live] for v in (at, x, diagonal, plus))
        if not live:
            break
        np.take(texts[column], b, out=at, mode="clip")
        np.add(at, base, out=at)
        np.take(table, at, out=x, mode="clip")
        np.bitwise_and(x, below, out=diagonal)
        diagonal += below
        diagonal ^= below
        diagonal |= x
        diagonal |= above
        np.bitwise_or(diagonal, below, out=plus)
        np.invert(plus, out=plus)
        plus |= above
        # What falls, then the vertical differences of the next column.
        below &= diagonal
        np.right_shift(diagonal, goal, out=x)
        x &= one
        hits += x
        diagonal >>= one
        np.bitwise_or(diagonal, plus, out=x)
        np.invert(x, out=x)
        below |= x
        np.bitwise_and(diagonal, plus, out=above)
        table >>= one
        table[entering[column + half]] |= top
    return near, sure


def line_classes(docs: DataFrame, id_column: str = "doc_id", text: str = "text", tau: Edits = TAU, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line: ``doc_id``, ``line_no``, ``class_doc``, ``class_line``, ``n_links``, ``h1``.

    ``class_doc`` and ``class_line`` are the first line of the class; ``n_links`` counts the different lines linked
    to this one. Lines under ``min_chars`` are their own class.
    """
    texts = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    with Stages(docs.sparkSession, "lines") as own:
        lines = own.write(find_lines(texts, min_chars), "lines", result=True)
        linked = links(texts, own, tau, min_chars)
        # The least place, a null id last.
        place = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "line_no")
        firsts = lines.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n"))
        firsts = own.write(firsts, "firsts")

        ends = linked.select(F.explode(F.array("a", "b")).alias("node"))
        degrees = ends.groupBy("node").agg(F.count("*").alias("n_links"))
        roots = degrees.join(components(linked, own), "node", "left").withColumn("root", F.coalesce("root", "node"))
        placed = own.write(roots.join(firsts.withColumn("node", _node("h1", "h2")), "node"), "placed")
        class_first = placed.groupBy("root").agg(F.min("first").alias("class_first"))
        near = placed.join(class_first, "root").select("h1", "h2", "class_first", "n_links")
        near = own.write(near, "near", done=("placed", "links"))

        # A line that comes once and has no links is its own class.
        all_firsts = firsts.join(near, ["h1", "h2"], "left").where("n > 1 OR n_links IS NOT NULL").select(
            F.col("h1").alias("_h1"),
            F.col("h2").alias("_h2"),
            F.coalesce("class_first", "first").alias("class_first"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
        # Staged, so that both sides of the join are shuffled for it and a line that comes very often can be split.
        all_firsts = own.write(all_firsts, "classes", done=("firsts", "near"), result=True)
    same = (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    out = lines.join(all_firsts, same, "left")
    alone = F.isnull("class_first")
    return out.select(
        "doc_id",
        "line_no",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_first.doc_id")).alias("class_doc"),
        F.when(alone, F.col("line_no")).otherwise(F.col("class_first.line_no")).alias("class_line"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "h1",
    )


def drop_repeated_lines(docs: DataFrame, tau: Edits = TAU, min_chars: int = MIN_CHARS, count: str | None = None, keep_under: int = 0) -> DataFrame:
    """The documents without the lines that are not the first of their class, with the columns they came with.

    Repeated lines of fewer than ``keep_under`` characters stay in a text that has other lines left; a document
    without a line that is the first of its class, blank ones apart, goes. ``count`` names a column of text lengths,
    which are renewed where lines go.
    """
    classes = line_classes(docs, tau=tau, min_chars=min_chars)
    is_first = F.col("class_doc").eqNullSafe(F.col("doc_id")) & (F.col("class_line") == F.col("line_no"))
    of, lost_lines = free_name("_id", docs), free_name("_lines_gone", docs)
    gone = classes.where(~is_first).groupBy(F.col("doc_id").alias(of)).agg(
        F.collect_set(F.struct("line_no", "h1")).alias(lost_lines)
    )
    gone = stage(gone, "lines-gone")
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col(of)), "left").drop(of)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, kept = [], []
            sizes = batch.column(count).to_pylist() if count in names else [None] * batch.num_rows
            both = zip(batch.column("text").to_pylist(), batch.column(lost_lines).to_pylist())
            for i, (text, lost) in enumerate(both):
                if lost:
                    lost_here = {(x["line_no"], x["h1"]) for x in lost}
                    numbers, lines, own = {n for n, _ in lost_here}, [], False
                    for n, line in enumerate((text or "").split("\n")):
                        bare = line.strip(_BLANK)
                        first = n not in numbers or (n, _id(bare.encode("utf-32-le", "surrogatepass"))) not in lost_here
                        own |= first and bool(bare)
                        if first or len(bare) < keep_under:
                            lines.append(line)
                    kept.append(own)
                    if len(lines) < (text or "").count("\n") + 1:
                        text = "\n".join(lines)
                        sizes[i] = len(text)
                else:
                    kept.append(True)
                texts.append(text)
            columns = {n: batch.column(n) for n in names} | {"text": pa.array(texts, pa.string())}
            if count in names:
                columns[count] = pa.array(sizes, pa.int64()).cast(columns[count].type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names).filter(pa.array(kept))

    return joined.mapInArrow(run, docs.schema)
