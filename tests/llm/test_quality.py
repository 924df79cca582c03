from __future__ import annotations

import zlib

import numpy as np

from tripmetrics.llm import quality


def test_held_out_documents_are_told_apart(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    trees = quality.train(docs, labels)
    scored = quality.add_score(docs, trees).join(labels, "doc_id").withColumn("held_out", quality.held_out()).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    held = [(r.score, r.quality) for r in scored if r.held_out]
    right = sum((s >= quality.THRESHOLD) == q for s, q in held) / len(held)
    assert len(held) > 50 and right > 0.95
    assert min(s for s, _ in held) >= 0 and max(s for s, _ in held) <= 1


def test_trees_fit_what_one_split_or_two_explain():
    r = np.random.default_rng(0)
    x = r.normal(size=(4000, 5))
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    score = quality.fit(x[:3000], y[:3000]).score(x[3000:])
    assert ((score > 0.5) == y[3000:]).mean() > 0.97


def test_walking_arrays_equals_walking_nodes():
    r = np.random.default_rng(1)
    trees = quality.fit(r.normal(size=(300, 3)), r.integers(0, 2, 300).astype(float), rounds=5, depth=3)
    for row in r.normal(size=(50, 3)):
        total = trees.base
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            total += value[node - len(feature)]
        assert abs(trees.score(row[None])[0] - 1 / (1 + np.exp(-total))) < 1e-12


def test_statistics_do_not_depend_on_neighbours():
    texts = [b"", b"One two. two", "é中 x".encode(), b"a" * 9_000_000, b"", b"W!! | w"]
    whole = quality.statistics(texts)
    assert whole.shape == (6, len(quality.STATISTICS)) and np.isfinite(whole).all()
    for i, t in enumerate(texts):
        assert np.allclose(whole[i], quality.statistics([t])[0])
    shares = whole[1, 1 : 1 + len(quality._KINDS)]
    assert abs(shares.sum() - 1) < 1e-12


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, 0.0), (1, "", 0.0), (None, "x", 0.0), (2, "y", 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (2, 1)], "doc_id long, quality int")
    scored = quality.add_score(docs, quality.train(docs, labels))
    assert scored.columns == ["doc_id", "text", "score"] and len({r.score for r in scored.collect() if not r.text}) == 1
    assert [r.score for r in quality.add_score(docs, quality.train(docs, labels.limit(0))).collect()] == [0.5] * 4
    assert quality.add_score(docs.limit(0), quality.train(docs.limit(0), labels)).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert not [r for r in docs.select(quality.held_out().alias("h")).collect() if r.h is None]
