"""The mix against exact fractions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import pytest

from tripmetrics.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Excess goes back to those below their limit, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        light = sum(w for s, w in weight.items() if s not in full)
        share = {s: Fraction(3 * sizes[s]) if s in full else Fraction(rest * weight[s], light) for s in names}
        over = {s for s in names if share[s] > 3 * sizes[s]}
        if not over:
            return share
        full |= over


def brute(rows):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += size(text)
    share, out = targets(sizes), []
    for source, target in share.items():
        expected = round(target / sizes[source] * mixing.UNIT) if sizes[source] else 0
        name = f"{mixing.SEED}:" + ("" if source is None else f"={source}")
        at = int(hashlib.md5(name.encode()).hexdigest()[:8], 16)
        own = sorted((-size(t), i is not None, i or 0) for i, t, s in rows if s == source)
        for n, known, i in own:
            copies = (at + expected) // mixing.UNIT - at // mixing.UNIT
            at += expected
            out.append((i if known else None, -n, sizes[source], float(target), -n * copies, copies))
    return out


def plan(df, **options):
    got = mixing.plan_mix(df, keep=["doc_id"], **options).select("doc_id", "size", "source_size", "target", "taken", "copies")
    return [tuple(r) for r in got.collect()]


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    assert all(abs(a[3] - b[3]) <= 1e-9 * max(1, b[3]) for a, b in zip(got, want))


def corpus(seed, sources, n=400):
    r = random.Random(seed)
    words = lambda: " \t\n\x0b "[r.randrange(5)].join(["wörd"] * r.choice([0, 1, 3, 10, 30, 200]))
    return [(i, r.choice(["", words()]) if r.random() < 0.1 else words(), sources[min(int(r.expovariate(0.7)), len(sources) - 1)]) for i in range(n)]


@pytest.mark.parametrize("sources", [["a"], ["b", "a"], ["src%d" % i for i in range(9)], ["é", "Z", "a", None, "", "\U0001f600", "￿"]])
def test_equals_exact_fractions(spark, sources):
    rows = corpus(len(sources), sources)
    got = plan(spark.createDataFrame(rows, SCHEMA).repartition(7))
    same(got, brute(rows))
    assert sum(r[3] / r[2] * r[1] for r in got if r[2]) == pytest.approx(sum(r[1] for r in got))
    by_source = {}
    for r in got:
        assert r[4] <= 3 * r[1]
        by_source.setdefault((r[2], r[3]), []).append(r)
    for (_, target), own in by_source.items():
        assert abs(sum(r[4] for r in own) - target) <= max(r[1] for r in own) + 1


def test_reruns_agree_and_a_seed_changes_them(spark):
    rows = corpus(3, ["x", "y", "z"])
    first = sorted(plan(spark.createDataFrame(rows, SCHEMA).repartition(1)))
    assert first == sorted(plan(spark.createDataFrame(rows[::-1], SCHEMA).repartition(13)))
    assert first != sorted(plan(spark.createDataFrame(rows, SCHEMA), seed="other"))


def test_null_and_repeated_rows_and_empty_tables(spark):
    text = "one two three"
    rows = [(1, text, "a")] * 7 + [(None, text, None)] * 4 + [(2, None, "b"), (3, "", "b"), (4, " \t ", "b"), (None, "four " * 5000, "a")]
    same(plan(spark.createDataFrame(rows, SCHEMA)), brute(rows))
    assert plan(spark.createDataFrame([], SCHEMA)) == []
    same(plan(spark.createDataFrame(rows[11:14], SCHEMA)), [(i, 0, 0, 0.0, 0, 0) for i in (2, 3, 4)])


def test_mixed_rows_keep_their_columns(spark):
    rows = [(i, "word " * (i % 5), "ab"[i % 2], i, 5, "p") for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA + ", size long, row int, _part string")
    out = mixing.mix(df)
    assert out.columns == [*df.columns, "copy"]
    copies = Counter(r.doc_id for r in out.collect())
    assert copies == Counter({r[0]: r[5] for r in plan(df) if r[5]})
    assert all(r.row == 5 and r._part == "p" and r.size == r.doc_id % 5 for r in out.collect())


def test_a_source_with_most_rows_is_many_parts(spark):
    """Running sums are windows over parts, and no window is over a whole source."""
    df = spark.range(5000).selectExpr("id AS doc_id", "repeat('w ', cast(id % 50 AS int)) AS text", "if(id % 9 = 0, 'b', 'a') AS source")
    out = mixing.plan_mix(df, keep=["doc_id"])
    shown = out._jdf.queryExecution().optimizedPlan().toString()
    over = [line for line in shown.splitlines() if "Window [" in line and "begins" in line]
    assert over and all("_part" in line for line in over)
    assert out.count() == 5000
