from __future__ import annotations

import base64
import hashlib
import random
import time
import tracemalloc

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from tripmetrics.llm import bpe

RANKS, FILE = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")


def texts():
    r = random.Random(11)
    parts = ["a", "a", "b", "an", " ", " ", "\n", "'", "s", "'ll", "1", "é", "中", "-", "=", "\t", " ", ".", "the", "а", "00", "\x1c", " ", "́", "\U0001f600"]
    made = ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(800)]
    return made + ["", " ", "  ", "\n", "don't.\nWe  x", "aa" * 50, "ab" * 40, "<|endoftext|> x", " lead", "trail ", "a\n\nb \n c", "ﬁ ß ÿŸ x́ ée ²³ ½"]


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(RANKS, P.PATTERN)


def test_equals_tiktoken_and_decodes(codec):
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    samples = texts()
    ids, counts = codec.encode(samples)
    ends = np.cumsum(counts)
    for text, end, count in zip(samples, ends, counts):
        own = ids[end - count : end]
        assert own.tolist() == other.encode_ordinary(text), text
        assert codec.decode(own).tobytes() == text.encode()
        starts, stops = codec.offsets(own, text)
        for i, a, b in zip(own, starts, stops):
            assert codec.token_bytes[i] in text[a:b].encode()
            if b - a == 1 or codec.token_bytes[i].decode(errors="ignore").encode() == codec.token_bytes[i]:
                assert a < b <= len(text)


def test_overlapping_merges_go_leftmost():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257, b"ab": 258, b"aba": 259, b"bab": 260}
    tokenizer, overlapping = bpe.tokenizer_of_ranks(ranks, P.PATTERN)
    assert overlapping
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for n in range(1, 12):
        for text in ("a" * n, "ab" * n, "ba" * n + "a"):
            assert bpe.merge_by_rank(text.encode(), ranks) == other.encode_ordinary(text)


@pytest.mark.parametrize("run", ["a", "0", "=", "-", "ab", "\xe9", "aaab"])
def test_long_runs(codec, run):
    """As tiktoken at lengths that it bears; at 200,000 characters the ids repeat and decode, in a moment."""
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    for n in (50, 333, 2000):
        assert codec.encode([run * n])[0].tolist() == other.encode_ordinary(run * n)
    text = run * (200_000 // len(run))
    began = time.perf_counter()
    ids = codec.encode([text])[0]
    assert time.perf_counter() - began < 20
    assert codec.decode(ids).tobytes() == text.encode()
    half = codec.encode([text[: len(text) // 2]])[0]
    assert ids[:1000].tolist() == half[:1000].tolist()


def test_equals_the_library_on_whole_texts():
    codec, whole = bpe.codec(FILE), Tokenizer.from_file(FILE)
    whole.encode_special_tokens = True
    for text in texts():
        assert codec.encode([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_memory_does_not_grow_with_the_positions_of_a_slice(codec):
    """Work arrays hold a bounded number of positions, not eight bytes and more for every byte of a slice."""
    r = random.Random(5)
    words = ["".join(r.choice("abcdefghij") for _ in range(8)) for _ in range(1000)]
    texts = [" ".join(r.choice(words) for _ in range(50_000)) for _ in range(9)]
    codec.encode(texts[:1])
    tracemalloc.start()
    try:
        ids, _ = codec.encode(texts)
        at_encoding = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        decoded = codec.decode(ids)
        at_decoding = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    size = sum(map(len, texts))
    assert decoded.tobytes() == "".join(texts).encode()
    assert at_encoding < 10 * size and at_decoding < 6 * size


def test_joined_words_equal_the_library(codec):
    """Many new words of a slice: letters with marks, accents, newlines and runs whose merges overlap."""
    r = random.Random(13)
    parts = ["a", "an", "é", "Ü", "ing", "re", "aaa", "q", "ß", "ñ", "T"]
    word = lambda: "".join(r.choice(parts) for _ in range(r.randrange(1, 6))) + r.choice(["", "", ".", ",", "!", ".\n", "\nx", "..", "1"])
    samples = [" ".join(word() for _ in range(400)) for _ in range(8)]
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    library = Tokenizer.from_file(FILE)
    for own, want in (
        (codec, other.encode_ordinary),
        (bpe.codec(FILE), lambda t: library.encode(t, add_special_tokens=False).ids),
    ):
        assert own.joins
        for _ in range(2):
            ids, counts = own.encode(samples)
            assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [want(t) for t in samples]
            own._clear()


def test_words_are_not_joined_where_a_token_reaches_over_a_cut(tmp_path):
    ranks = {bytes([b]): b for b in range(256)} | {b"o ": 256, b"to": 257}
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % n for t, n in ranks.items()))
    own = bpe.Codec(str(path), P.PATTERN)
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert not own.joins
    assert own.encode(["go to do to"])[0].tolist() == other.encode_ordinary("go to do to")


def test_columns_digests_and_split_characters(spark):
    rows = [(1, "héllo 中文", 0), (2, None, 0), (3, "", 0), (1, "héllo 中文", 0), (None, "x " * 300_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    coded = bpe.encode(df, RANKS, P.PATTERN, offsets=True)
    assert coded.columns == ["doc_id", "text", "ids", "starts", "stops"]
    out = bpe.decode(coded, RANKS, P.PATTERN).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in out)
    assert all(len(r.ids) == len(r.starts) == len(r.stops) for r in out)
    # Cut between the bytes of a character.
    ids = bpe.codec(RANKS, P.PATTERN).encode(["\U00010348"])[0].tolist()
    cut = spark.createDataFrame([(ids[:1],), (ids[1:],), (None,)], "ids array<bigint>")
    assert b"".join(bytes(r.decoded) for r in bpe.decode(cut, RANKS, P.PATTERN).collect()) == "\U00010348".encode()
    digests = {r.doc_id: r for r in bpe.digests(df, RANKS, P.PATTERN).collect()}
    assert digests[2].n_tokens == 0 and digests[2].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert digests[None].decoded_sha256 == hashlib.sha256(b"x " * 300_000).hexdigest()
    assert bpe.digests(df.limit(0), RANKS, P.PATTERN).count() == 0
