from __future__ import annotations

import random

import pytest

from tests.llm import brute
from tripmetrics.llm import decontaminate
from tripmetrics.llm.decontaminate import drop_contaminated, mark_passages


def tables():
    r = random.Random(5)
    vocabulary = "a b c dé e1 F".split()
    text = lambda n: r.choice([" ", "-", ". "]).join(r.choice(vocabulary) for _ in range(n))
    items = [(i, text(r.choice([1, 2, 4, 9, 10, 11, 14]))) for i in range(12)] + [(3, text(12)), (None, text(3)), (50, ""), (51, None), (52, "!?")]
    docs = [(i, text(r.choice([0, 1, 3, 12, 60]))) for i in range(60)]
    docs += [(60 + i, f"{text(20)} {items[i][1].upper()} {text(5)}") for i in range(12)] + [(99, None), (100, ""), (99, "a b")]
    return docs, items


@pytest.mark.parametrize("limit", [1 << 20, 60])
def test_equals_comparing_every_window(spark, limit):
    docs, items = tables()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.text or "", r.n_words, r.n_hit, r.n_items, tuple(r.items)) for r in mark_passages(df, benchmark, max_pass_bytes=limit).collect())
    want = []
    for doc, text in docs:
        n, hit, found = brute.contamination(text, items)
        found = [x for x in found if x != "None"]
        want.append((doc, text or "", n, hit, len(found), tuple(found)))
    assert got == sorted(want)
    kept = {(r.doc_id, r.text) for r in drop_contaminated(df, benchmark).collect()}
    assert kept == {(d, t) for d, t in docs if not brute.contamination(t, items)[1]}


def test_spans_long_texts_and_clashing_columns(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    filler = "zero " * 200_000
    docs = spark.createDataFrame([(1, filler + passage + " " + filler, 7)], "doc_id long, text string, n_hit long")
    benchmark = spark.createDataFrame([(4, passage)], "item_id long, text string")
    row = mark_passages(docs, benchmark).first()
    assert (row.n_words, row.n_hit, row["items"]) == (400_011, 11, ["4"])
    assert [tuple(s) for s in row.hit_spans] == [(200_000, 200_011)]
    assert drop_contaminated(docs, benchmark).columns == docs.columns
    assert mark_passages(docs, benchmark.limit(0)).first().n_hit == 0
    assert mark_passages(docs.limit(0), benchmark).count() == 0


def test_windows_of_a_pass_are_built_once_for_a_worker():
    items = tuple((str(i), f"one two three four {i}".encode()) for i in range(5))
    first = decontaminate._passages(items, 10)
    assert decontaminate._passages(tuple(items), 10) is first
    assert decontaminate._passages(items[:2], 10) is not first
