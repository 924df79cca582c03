"""Byte-level BPE: encode texts to ids with offsets, and decode ids to bytes.

The tokenizers library merges; this module feeds it. A text is cut only where the splitting pattern always
cuts (before a single space between two other characters, and around runs of Latin letters), and equal pieces
of a slice are encoded once. Where no token reaches over such a cut, no merge does, and the model gets many new words in
one string. Every byte of a piece is written as one character, the byte table that byte-level
vocabularies use; decoding reverses the table, so characters that are split over ids come back whole.

Two sources of a vocabulary: a tokenizers file, or a file of ranks, for which the merges are derived: every way
to cut a token into two tokens is a merge with the token's rank. Where two such merges overlap (their token is a
run of a shorter word, as in ``aaa``), the leftmost has to go first, which a list of merges can't say; pieces that
hold such an overlap are found with an Aho-Corasick automaton and merged here by rank.

Results for odd input: null and empty texts have no ids and decode to no bytes. Very long texts are whole; a
slice of a batch holds one of them at a time. Repeated rows stay. Ids outside the vocabulary fail the decoding.
Added columns replace columns of the same name.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

from tripmetrics.llm.batches import extended, gather, slices

# Pieces and words kept between slices; a fuller cache is emptied.
CACHE_ENTRIES = 500_000
# New words that the model gets in one string.
_JOINED = 32
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
# Fixed value: all white space that any of the libraries knows.
_WHITE = " \t\n\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A space beside other white space or at an end: where these occur, words are cut by a slower pattern.
_ODD_SPACE = rf" [{_WHITE}]|[{_WHITE}] |\A | \z"
_WORD_CUT = re.compile(rf"(?<=[^{_WHITE}]) (?=[^{_WHITE}])")
# Words that may be cut around letters: no apostrophe (it may belong to letters), no space but single newlines.
_PLAIN = re.compile(rf"(?:[\x21-\x26\x28-\x7e{_LATIN}]|(?<!\n)\n(?!\n))*")
# Most words: letters, and at most one mark behind them.
_COMMON = re.compile(rf"( ?[{_LATIN}]+)([.,;:!?]?)")
_JOINABLE = rf"\A[{_LATIN}]+[.,;:!?]?(?:\n[{_LATIN}]+[.,;:!?]?)*\z"
# What joined words have where they are cut: anything else behind letters, and letters or a space behind anything else.
_LAST = rb"(?:[A-Za-z]|(?:\A|\xc3)[\x80-\x96\x98-\xb6\xb8-\xbf])"
_OVER_CUT = re.compile(_LAST + rb"[ \n.,;:!?]|[.,;:!?] |[\n.,;:!?][A-Za-z\xc3]")
_RUNS = re.compile(rf"[{_LATIN}]+|[^{_LATIN}]+")
_LETTERS = re.compile(rf"[{_LATIN}]+")


def byte_table() -> list[str]:
    """The character for each byte: printable ones stand for themselves, the others follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def tokenizer_of_ranks(ranks: dict[bytes, int], pattern: str) -> tuple[Tokenizer, set[bytes]]:
    """A tokenizer that merges by ``ranks``, and the texts in which two merges to one token overlap."""
    table = byte_table()
    name = lambda token: "".join(table[b] for b in token)
    merges, overlapping = [], set()
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        cuts = [i for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        merges += [(name(token[:i]), name(token[i:])) for i in sorted(cuts, key=lambda i: (ranks[token[:i]], ranks[token[i:]]))]
        # Cut at i into a, b and at j into b, c, with the same b: a, b, c can be merged in two ways.
        overlapping.update(token[:i] + token for i in cuts for j in cuts if token[i:] == token[:j])
    tokenizer = Tokenizer(models.BPE({name(t): r for t, r in ranks.items()}, merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    tokenizer.decoder = decoders.ByteLevel()
    return tokenizer, overlapping


def merge_by_rank(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the leftmost of the pairs of least rank until none has one.

    Pairs wait in a heap by rank and place; those of which a part has been merged meanwhile are passed over. So a run
    of n bytes takes in the order of n log n steps.
    """
    if piece in ranks:
        return [ranks[piece]]
    size = len(piece)
    # The end of the part that begins at a place, 0 inside parts, and where the part before it begins.
    ends, before = list(range(1, size + 1)), list(range(-1, size - 1))
    waiting = [(ranks[piece[i : i + 2]], i, i + 1, i + 2) for i in range(size - 1) if piece[i : i + 2] in ranks]
    heapq.heapify(waiting)
    while waiting:
        _, start, middle, end = heapq.heappop(waiting)
        if ends[start] != middle or ends[middle] != end:
            continue
        ends[start], ends[middle] = end, 0
        if end < size:
            before[end] = start
            rank = ranks.get(piece[start : ends[end]])
            if rank is not None:
                heapq.heappush(waiting, (rank, start, end, ends[end]))
        first = before[start]
        if first >= 0:
            rank = ranks.get(piece[first:end])
            if rank is not None:
                heapq.heappush(waiting, (rank, first, start, end))
    out, at = [], 0
    while at < size:
        out.append(ranks[piece[at : ends[at]]])
        at = ends[at]
    return out


class Codec:
    """Encodes and decodes texts of one vocabulary."""

    def __init__(self, path: str, pattern: str | None = None):
        """``path`` is a tokenizers file, or with ``pattern`` a file of ranks."""
        self.ranks: dict[bytes, int] | None = None
        self.overlaps = ahocorasick.Automaton()
        if pattern is None:
            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.encode_special_tokens = True
        else:
            self.ranks = read_ranks(path)
            self.tokenizer, overlapping = tokenizer_of_ranks(self.ranks, pattern)
            for text in overlapping:
                self.overlaps.add_word(text.decode("latin-1"), 0)
            self.overlaps.make_automaton()
        self.as_chars = dict(enumerate(byte_table()))
        self.as_bytes = back = {c: b for b, c in self.as_chars.items()}
        vocabulary = sorted((i, t) for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items())
        self.token_bytes = [b""] * (vocabulary[-1][0] + 1)
        for i, token in vocabulary:
            self.token_bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.sizes = np.array([len(t) for t in self.token_bytes], np.int32)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(self.token_bytes), np.uint8)
        self.joins = self._can_join()
        self._clear()

    def _clear(self) -> None:
        """Numbers of words in the pool of ids: of words behind a space, and of words at a text's beginning."""
        self.pool, self.starts = array("I"), array("q", [0])
        self.words: dict[str, int] = {}
        self.firsts: dict[str, int] = {}
        self.pieces: dict[str, bytes] = {}

    def _can_join(self) -> bool:
        """Whether no token reaches over a cut of joined words, and every token of a word is what merges make of it."""
        if any(_OVER_CUT.search(t) for t in self.token_bytes):
            return False
        merge = lambda chars: [t.id for t in self.tokenizer.model.tokenize(chars)]
        for mark in ("\n", *(m + "\n" for m in ".,;:!?")):
            if self.tokenizer.encode(mark, add_special_tokens=False).ids != merge(mark.translate(self.as_chars)):
                return False
        whole = [i for i, t in enumerate(self.token_bytes) if re.fullmatch(rb" [A-Za-z\x80-\xff]+", t)]
        names = map(self.tokenizer.id_to_token, whole)
        # A string of two words is no token itself, so it is merged even where whole tokens are looked up first.
        end = self.as_chars[32] + self.as_chars[46]
        return all(merge(name + end)[:1] == [i] for i, name in zip(whole, names))

    def _joined(self, words: list[str]) -> np.ndarray | None:
        """The ids of words, each behind a space; nothing where two merges may overlap."""
        text = " " + " ".join(words)
        latin = text if text.isascii() else text.encode().decode("latin-1")
        if len(self.overlaps) and next(self.overlaps.iter(latin), None):
            return None
        chars = text.replace(" ", self.as_chars[32]).replace("\n", self.as_chars[10]) if latin is text else latin.translate(self.as_chars)
        return np.array([t.id for t in self.tokenizer.model.tokenize(chars)], np.uint32)

    def _lookup(self, words: pa.Array, known: dict[str, int], before: str) -> np.ndarray:
        """Numbers of different words; new ones are encoded."""
        # Faster than to_pylist, which makes a scalar of each.
        listed = words.to_numpy(zero_copy_only=False).tolist()
        numbers = np.array([*map(known.get, listed, repeat(-1))], np.int64)
        missing = np.flatnonzero(numbers < 0)
        if not len(missing):
            return numbers
        joins = np.zeros(len(missing), bool)
        if self.joins and before == " ":
            new = words.take(pa.array(missing))
            joins = pa.compute.match_substring_regex(new, _JOINABLE).to_numpy(zero_copy_only=False)
        alone, together = missing[~joins].tolist(), missing[joins].tolist()
        sizes = pa.compute.binary_length(words.take(pa.array(missing[joins]))).to_numpy() + 1
        for k in range(0, len(together), _JOINED):
            part = together[k : k + _JOINED]
            texts = [listed[i] for i in part]
            ids = self._joined(texts)
            if ids is None:
                alone += part
                continue
            ends = np.cumsum(sizes[k : k + _JOINED])
            numbers[part] = np.arange(len(part)) + (len(self.starts) - 1)
            # A word's last token ends where the word does.
            stops = len(self.pool) + 1 + np.searchsorted(np.cumsum(self.sizes[ids]), ends)
            self.starts.frombytes(stops.astype(np.int64).tobytes())
            self.pool.frombytes(ids.tobytes())
        for i in alone:
            numbers[i] = len(self.starts) - 1
            self.pool.frombytes(self._encode_word(before + listed[i]))
            self.starts.append(len(self.pool))
        known.update(zip([listed[i] for i in missing.tolist()], numbers[missing].tolist()))
        return numbers

    def _encode_word(self, word: str) -> bytes:
        """The ids of a word as unsigned 32-bit numbers; so are those of pieces."""
        common = _COMMON.fullmatch(word)
        if common:
            runs = common.groups() if common[2] else common.groups()[:1]
        elif word == " " or not _PLAIN.fullmatch(word, 1 if word[:1] == " " else 0):
            return self._encode_piece(word)
        elif word[:1] == " ":
            runs = _RUNS.findall(word, 1)
            runs[0] = " " + runs[0]
        else:
            runs = _RUNS.findall(word)
        out = b""
        for run in runs:
            ids = self.pieces.get(run)
            if ids is None:
                ids = self.pieces[run] = self._encode_piece(run)
            out += ids
        return out

    def _encode_piece(self, piece: str) -> bytes:
        """One letter run goes to the model as it is; anything else is split by the tokenizer first."""
        latin = piece if piece.isascii() else piece.encode().decode("latin-1")
        if len(self.overlaps) and next(self.overlaps.iter(latin), None):
            parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)
            ids = [i for part, _ in parts for i in merge_by_rank(bytes(map(self.as_bytes.get, part)), self.ranks)]
        elif _LETTERS.fullmatch(piece, 1 if piece[:1] == " " else 0):
            chars = latin.replace(" ", self.as_chars[32], 1) if latin is piece else latin.translate(self.as_chars)
            ids = [t.id for t in self.tokenizer.model.tokenize(chars)]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and how many each text has."""
        if len(self.words) + len(self.firsts) + len(self.pieces) > CACHE_ENTRIES:
            self._clear()
        odd = pa.compute.match_substring_regex(pa.array(texts, pa.large_string()), _ODD_SPACE).to_pylist()
        odd = [o or not t for o, t in zip(odd, texts)]
        plain, counts = self._numbers([t for t, o in zip(texts, odd) if not o])
        if any(odd):
            runs = iter(np.split(plain, np.cumsum(counts)[:-1]))
            each = [self._odd_numbers(t) if o else next(runs) for t, o in zip(texts, odd)]
            plain, counts = np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))
        starts = np.frombuffer(self.starts, np.int64)
        pool = np.frombuffer(self.pool, np.uint32) if len(self.pool) else np.zeros(0, np.uint32)
        lengths = np.diff(starts)
        ids = gather(pool, starts, lengths, plain)
        edges = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        before = np.concatenate([[0], np.cumsum(lengths[plain])])
        # The pool can't grow while an array looks into it.
        del starts, pool
        return ids, np.diff(before[edges])

    def _numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of texts that single spaces part, and how many each text has. Arrow splits them and
        finds the different ones, which are looked up once."""
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lists = pa.compute.split_pattern(pa.array(texts, pa.large_string()), " ")
        flat, ends = lists.flatten(), lists.offsets.to_numpy()
        coded = flat.dictionary_encode()
        numbers = self._lookup(coded.dictionary, self.words, " ")[coded.indices.to_numpy()]
        # The first word of a text has no space before it.
        firsts = flat.take(pa.array(ends[:-1])).dictionary_encode()
        numbers[ends[:-1]] = self._lookup(firsts.dictionary, self.firsts, "")[firsts.indices.to_numpy()]
        return numbers, np.diff(ends)

    def _odd_numbers(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int64)
        first, *rest = _WORD_CUT.split(text)
        found = [self._lookup(pa.array([first], pa.large_string()), self.firsts, "")]
        if rest:
            coded = pa.array(rest, pa.large_string()).dictionary_encode()
            found.append(self._lookup(coded.dictionary, self.words, " ")[coded.indices.to_numpy()])
        return np.concatenate(found)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids as one array."""
        return gather(self.bytes, self.places, self.sizes, ids)

    def offsets(self, ids: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character and the one after the last of every id; ids that share a character both have it."""
        raw = np.frombuffer(text.encode(), np.uint8)
        begins = (raw & 0xC0) != 0x80
        number = np.cumsum(begins) - 1
        stops = np.cumsum(self.sizes[ids])
        return number[stops - self.sizes[ids]], number[stops - 1] + 1


_CODECS: dict[tuple, Codec] = {}


def codec(path: str, pattern: str | None = None) -> Codec:
    """One codec per Python worker and vocabulary."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def texts_of(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def _split(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def encode(docs: DataFrame, path: str, pattern: str | None = None, text: str = "text", offsets: bool = False) -> DataFrame:
    """Add ``ids``, and with ``offsets`` the characters ``starts`` to ``stops`` that each id comes from."""
    names = ["ids", "starts", "stops"] if offsets else ["ids"]
    kept = docs.drop(*(n for n in names if n != text))
    schema = extended(kept, ", ".join(f"{n} array<{'bigint' if n == 'ids' else 'int'}>" for n in names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            c, texts = codec(path, pattern), texts_of(batch.column(text))
            ids, counts = c.encode(texts)
            columns = [_split(ids, counts, pa.int64())]
            if offsets:
                ends = np.cumsum(counts)
                found = [c.offsets(ids[e - n : e], t) for e, n, t in zip(ends, counts, texts)]
                for side in zip(*found):
                    columns.append(_split(np.concatenate([[], *side]).astype(np.int32), counts, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    return kept.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str | None = None, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the bytes that ``ids`` stand for; null ids have none, and cutting ids anywhere cuts only bytes."""
    kept = encoded.drop(name)
    schema = extended(kept, f"{name} binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, lists = codec(path, pattern), batch.column(ids)
            rows = [c.decode(np.asarray(x.values, np.int64)).tobytes() if x.is_valid else b"" for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.binary())], schema.names)

    return kept.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text, decode its ids again, and return ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    Ids are hashed as little-endian unsigned 32-bit numbers. Nothing but the digests leaves the task.
    """
    names = [id_column, "n_tokens", "ids_sha256", "decoded_sha256"]
    schema = extended(docs.select(id_column), "n_tokens bigint, ids_sha256 string, decoded_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            c = codec(path, pattern)
            ids, counts = c.encode(texts_of(batch.column(text)))
            ends = np.cumsum(counts)
            raw = ids.astype("<u4", copy=False)
            decoded = c.decode(ids)
            stops = np.concatenate([[0], np.cumsum(c.sizes[ids], dtype=np.int64)])[ends]
            sides = [
                [hashlib.sha256(a).hexdigest() for a in np.split(whole, cuts[:-1])]
                for whole, cuts in ((raw, ends), (decoded, stops))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), pa.array(counts, pa.int64()), *(pa.array(s, pa.string()) for s in sides)], names
            )

    return docs.select(id_column, text).mapInArrow(run, schema)
