from __future__ import annotations

import random

from pyspark.sql import functions as F

from tests.llm import brute
from tripmetrics.llm import simhash
from tripmetrics.sources import Stages
from tripmetrics.llm.components import components


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)] + [(201, 200), (202, 201), (200, 202), (5, 5), (7, 0)]
    df = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    want = brute.components({x for e in edges for x in e}, edges)
    assert {r.node: r.root for r in components(df).collect()} == {n: r for n, r in want.items() if n != r}
    assert components(df.limit(0)).count() == 0


def test_links_have_the_components_of_all_close_pairs(spark):
    r = random.Random(2)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    base = [r.getrandbits(64) for _ in range(40)]
    prints = {b ^ sum(1 << k for k in r.sample(range(64), r.choice([0, 1, 2, 3, 4]))) for b in base for _ in range(6)}
    # A large group around one value, in which a key is shared by many.
    prints |= {base[0] ^ 1 << a ^ 1 << b for a in range(12) for b in range(12)} | {base[1] ^ (k << 50) for k in range(200)}
    prints = sorted(map(signed, prints))
    pairs = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    want = brute.components(prints, pairs)
    found = simhash.links(spark.createDataFrame([(p,) for p in prints], "bits long"), Stages(spark, "simhash"))
    assert brute.components(prints, [(x.a, x.b) for x in found.collect()]) == want


def documents():
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdeÉ") for _ in range(4))
    texts = []
    for _ in range(12):
        words = [word() for _ in range(300)]
        texts.append(" ".join(words))
        for k in (1, 1, 2):
            texts.append("\t".join(word() if i < k else w.upper() for i, w in enumerate(words)))
    return [*texts, "", None, "  ", "one", "One two", "one\ntwo three", texts[0], texts[5]]


def test_equals_comparing_every_pair(spark):
    texts = documents()
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, bits int")
    prints, root = brute.simhash_components(texts)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert got == {i: (f"{prints[i]:016x}", root[i]) for i in range(len(texts))}
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root.values()))


def test_null_ids_repeated_rows_and_empty_tables(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (4, "x y z w"), (4, "x y z w"), (None, "x y z w"), (4, "quite another text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id or 0) for r in simhash.near_duplicates(df).collect())
    assert got == [(False, 4, 4)] * 3 + [(True, 0, 0), (True, 0, 0), (True, 0, 4)]
    kept = sorted((r.doc_id or 0, r.text) for r in simhash.keep_first(df).collect())
    assert kept == [(0, "a b c d"), (4, "quite another text"), (4, "x y z w")]
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    assert simhash.keep_first(df.limit(0)).count() == 0


def test_hashes_are_those_of_the_engine(spark):
    text = "one two three"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] == simhash.fingerprint(text.encode())
