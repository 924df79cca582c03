from __future__ import annotations

import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from tripmetrics.llm import spotsigs


def hash_of(*parts):
    """Chained XXH64 of the parts, each seeded with the one before."""
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def slow(text):
    words = [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]
    chains = set()
    content = [i for i, w in enumerate(words) if w not in spotsigs.COMMON]
    for i, w in enumerate(words):
        after = [words[j] for j in content if j > i][:2]
        if w in spotsigs.ANCHORS and len(after) == 2:
            chains.add(hash_of(w, *after))
    if not chains:
        pairs = list(zip(words, words[1:])) or [(w, "") for w in words]
        chains = {hash_of(*p) for p in pairs}
    return sorted(chains)


def likeness(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def documents():
    r = random.Random(3)
    vocabulary = ["the", "a", "and", "is", "of", "la", "et"] + [f"w{i}é" for i in range(30)]
    texts = [" ".join(r.choice(vocabulary) for _ in range(r.choice([0, 1, 2, 5, 40, 200]))) for _ in range(40)]
    return [(i * 3 % 41, t) for i, t in enumerate(texts)] + [(100, None), (101, ""), (102, "!!"), (103, "Mixed, CASE the one-two"), (104, "中文 the 中文 字")]


def test_equals_plain_python(spark):
    rows = documents()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, hashes string").repartition(7)
    got = {r.doc_id: r for r in spotsigs.edit_and_compare(df).collect()}
    ordered = sorted((d, t or "") for d, t in rows)
    assert len(got) == len(rows)
    for (doc, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        row, half = got[doc], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, new = slow(text), slow(edited)
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == "".join(f"{h & (1 << 64) - 1:016x}" for h in own)
        assert row.edited_fingerprint == "".join(f"{h & (1 << 64) - 1:016x}" for h in new)
        assert abs(row.near_edited - likeness(own, new)) < 1e-12
        assert abs(row.near_next - likeness(own, slow(after))) < 1e-12


def test_null_and_repeated_ids_and_few_rows(spark):
    rows = [(5, "the red fox jumps"), (5, "a blue fox sleeps"), (5, "the red fox jumps"), (None, "the old dog barks"), (9, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.edited_sha256) for r in spotsigs.edit_and_compare(df).collect()))
    sha = lambda text, after: hashlib.sha256((text[: len(text) - len(text) // 2] + after[: len(text) // 2]).encode()).hexdigest()
    want = [(d or 0, sha(t, {5: "x", None: "a blue fox sleeps", 9: "the old dog barks"}[d])) for d, t in rows]
    assert got == sorted(want)
    one = spotsigs.edit_and_compare(df.where("doc_id = 9")).first()
    assert (one.near_edited, one.near_next) == (1.0, 1.0)
    assert spotsigs.edit_and_compare(df.limit(0)).count() == 0


def test_search_equals_comparing_every_pair(spark):
    r = random.Random(5)
    sets = {}
    for i in range(60):
        base = r.sample(range(400), r.choice([1, 3, 10, 40]))
        for k in range(3):
            sets[3 * i + k] = sorted({*base[k:], *r.sample(range(400), k)})
    df = spark.createDataFrame(list(sets.items()), "id long, hashes array<bigint>")
    for least in (0.5, 0.8):
        want = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and likeness(sets[a], sets[b]) >= least}
        got = [(x.a, x.b) for x in spotsigs.similar_pairs(df, least).collect()]
        assert sorted(got) == sorted(want)


def test_only_built_in_functions(spark, capsys):
    df = spark.createDataFrame(documents(), "doc_id long, text string")
    spotsigs.edit_and_compare(df).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
    assert df.select(F.xxhash64(F.lit("a"), F.lit("bé"))).first()[0] == hash_of("a", "bé")
