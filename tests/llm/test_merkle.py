"""The manifest against trees in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tripmetrics.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = {c: c + 32 for c in range(65, 91)}


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row, lower=False):
    doc, text, lang, source, n = row
    if lower and text is not None:
        text = text.translate(LOWER)
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)]
    return digest(*fields)


def climb(hashes):
    """The top, and for every node its siblings as (left, right) by level."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(level) > 1:
        for i, place in enumerate(at):
            first = place // 8 * 8
            run = level[first : first + 8]
            paths[i].append(("".join(run[: place - first]), "".join(run[place - first + 1 :])))
            at[i] = place // 8
        level = [digest(*level[i : i + 8]) for i in range(0, len(level), 8)]
    return level[0], paths


def brute(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))):
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([leaf(r) for r in groups[g]]) for g in names}
    root, over = climb([trees[g][0] for g in names])
    out = []
    for g, upper in zip(names, over):
        top, paths = trees[g]
        for row, path in zip(groups[g], paths):
            path = path + upper
            own = leaf(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0)
            for left, right in path:
                own = digest(left, own, right)
            out.append((row[0], leaf(row), top, root, digest(*[x + y for x, y in path]), own, own == root))
    return sorted(out, key=repr)


def verified(df):
    return sorted((tuple(r) for r in merkle.verify(df).collect()), key=repr)


def documents(n, langs, start=0):
    return [(i * 7 - 20, ["Some Text %d", "no upper %d", "ÄÖ %d \U0001f600"][i % 3] % i, langs[i * i % len(langs)], f"s{i % 3}", i) for i in range(start, n)]


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 600])
def test_one_group(spark, n):
    rows = documents(n, ["en"])
    assert verified(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


@pytest.mark.parametrize("langs", [["en", "de", None], [None], ["", "-", "é", "Z", "a"], [f"l{i:02d}" for i in range(70)]])
def test_groups_of_different_heights(spark, langs):
    rows = documents(300, langs) + [(10**6 + i, "Tail", "en", None, None) for i in range(90)]
    got = verified(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert got == brute(rows)
    assert {True, False} == {r[-1] for r in got}


def test_null_repeated_and_long_rows(spark):
    rows = [(None, None, None, None, None)] * 9 + [(3, "A", "en", "s", 1)] * 20 + [(3, "B", "en", "s", 1)]
    rows += [(5, "", "en", "", 0), (-(2**63), "x", "en", "s", 1), (2**63 - 1, "Y" * 300_000, "en", "s", 1), (6, "nul\0 ﻿", "de", "s", 1)]
    assert verified(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    rows = documents(80, ["en", "de"])
    names = ("key", "place", "path", "leaf", "id", "_part", "n", "hash")
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(n) for n in names})
    assert verified(df) == brute(rows)
    assert verified(df.limit(0)) == []


def test_what_a_proof_finds(spark):
    """A row that isn't touched gives the root; any change of any field doesn't."""
    rows = documents(100, ["en", "de"])
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA))
    assert found.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    wrong = F.sha2(F.concat("leaf", F.lit("x")), 256)
    assert found.where(merkle.fold(wrong, F.col("path")) == F.col("root")).count() == 0
