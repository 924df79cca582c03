from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tripmetrics.llm import token_files as tf

FILE = P.path("byte_bpe_50k.json")


def blocks():
    r = np.random.default_rng(1)
    made = [[5], [7] * 300, r.integers(0, 50_000, 4096), np.tile([1, 2, 3, 900_000], 500), r.zipf(1.3, 3000) % 60_000, [0, 2**32 - 1], r.integers(0, 3, 1500)]
    return [np.asarray(b, np.uint32) for b in made]


def test_blocks_come_back_whatever_runs_beside_them():
    want = blocks()
    coded = tf.encode_blocks(want)
    assert [tf.encode_blocks([b])[0] for b in want] == coded
    for a, b in zip(tf.decode_blocks(coded), want):
        assert a.tolist() == b.tolist()
    assert tf.decode_blocks(coded[3:4])[0].tolist() == want[3].tolist()


def test_repetition_is_learned():
    r = random.Random(2)
    phrase = [r.randrange(40_000) for _ in range(300)]
    assert len(tf.encode_blocks([np.array(phrase * 13, np.uint32)])[0]) < 4 * 300 + 700
    assert len(tf.encode_blocks([np.array([9] * 4096, np.uint32)])[0]) < 200


def test_a_damaged_block_is_noticed():
    coded = tf.encode_blocks(blocks()[4:5])[0]
    broken = coded[:-40] + bytes([coded[-40] ^ 1]) + coded[-39:]
    with pytest.raises(ValueError):
        tf.decode_blocks([broken])


@pytest.mark.parametrize("size", [tf.BLOCK_IDS, 64])
def test_files_equal_the_library(spark, monkeypatch, size):
    monkeypatch.setattr(tf, "BLOCK_IDS", size)
    r = random.Random(4)
    rows = [(i * 7 % 50, " ".join(r.choice(["one", "two", "é", "中\n"]) for _ in range(r.choice([0, 3, 400])))) for i in range(50)]
    rows += [(60, None), (61, ""), (62, "long text " * 20_000), (None, "no id"), (3, "again"), (62, "long text " * 20_000)]
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, start int").repartition(5)
    whole = Tokenizer.from_file(FILE)
    coded = lambda t: [*whole.encode(t or "", add_special_tokens=False).ids, 0]
    got = sorted(tf.write_and_read(df, FILE).collect(), key=lambda x: x.start)
    assert [x.doc_id for x in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    start = 0
    for x in got:
        assert x.start == start
        start += x.n_tokens
    have = sorted((str(x.doc_id), x.n_tokens, x.ids_crc32) for x in got)
    assert have == sorted((str(d), len(coded(t)), zlib.crc32(np.array(coded(t), "<u4").tobytes())) for d, t in rows)
    assert tf.write_and_read(df.limit(0), FILE).count() == 0


def test_several_files_for_a_task(spark, monkeypatch, tmp_path):
    rows = [(i, f"text number {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = tf.IdFile(f"file://{tmp_path}/ids")
    ids, counts = tf.codec(FILE).encode([t for _, t in rows])
    made.add([d for d, _ in rows], ids, counts)
    name, docs, n = made.close()
    assert (docs, n) == (40, len(ids))
    read = [(d, np.concatenate(list(p)).tolist()) for d, _, p in tf.read_ids(f"file://{tmp_path}/ids", name)]
    assert [x for _, y in read for x in y] == ids.tolist() and [d for d, _ in read] == [d for d, _ in rows]
    assert df.count() == 40


def test_files_close_by_documents_too(spark, monkeypatch):
    """Very many short texts: with a lowered bound a task writes several files, and rows come out in pieces."""
    monkeypatch.setattr(tf, "FILE_DOCS", 100)
    monkeypatch.setattr(tf, "_ROWS_OUT", 30)
    df = spark.range(0, 3000, 1, 2).selectExpr("id AS doc_id", "if(id % 3 = 0, 'a b', '') AS text")
    folder = tf.scratch_path(spark, "ids")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        manifest = tf.write_ids(df, folder, FILE)
        got = sorted(tf.read_documents(manifest, folder).collect(), key=lambda x: x.doc_id)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert manifest.count() > 10 and max(r.docs for r in manifest.collect()) < 200
    assert [(r.doc_id, r.n_tokens) for r in got] == [(i, 3 if i % 3 == 0 else 1) for i in range(3000)]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(0, 3000)]


def test_ids_are_numbered_alike_by_table_and_by_sorting(monkeypatch):
    want = blocks()[:5] + blocks()[6:]
    want = [b for b in want if b.max() < tf._TABLE]
    coded = tf.encode_blocks(want)
    monkeypatch.setattr(tf, "_TABLE", 0)
    assert len(want) > 3 and tf.encode_blocks(want) == coded
