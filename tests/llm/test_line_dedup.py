from __future__ import annotations

import random
import uuid

import numpy as np
import pytest

from tests.llm import brute
from tripmetrics.llm import line_dedup
from tripmetrics.sources import stages


def edited(r, s, n, letters="abcé 中"):
    for _ in range(n):
        i, kind = r.randrange(len(s) + 1), r.randrange(3)
        s = s[:i] + (r.choice(letters) if kind else "") + s[i + (kind != 1) :]
    return s


def corpus(seed=1):
    r = random.Random(seed)
    line = lambda n: "".join(r.choice("abcdé 中\U0001f600") for _ in range(n)).strip() or "x"
    base = [line(r.choice([18, 19, 20, 21, 22, 30, 60, 200])) for _ in range(25)]
    pool = base + [edited(r, r.choice(base), r.choice([1, 2, 2, 3])) for _ in range(150)]
    docs = [(i, "\n".join(r.choice(["", "  ", "\r", " "]) + r.choice(pool) for _ in range(r.randrange(8)))) for i in range(70)]
    return [*docs, (70, None), (71, ""), (72, "\n\n"), (73, docs[3][1]), (74, base[0] + "\n" + base[0])]


def rows(df):
    return sorted((r.doc_id, r.line_no, r.class_doc, r.class_line, r.n_links) for r in df.collect())


def test_within_equals_the_full_table():
    r = random.Random(9)
    for _ in range(4000):
        a = "".join(r.choice("ab") for _ in range(r.randrange(12)))
        b = edited(r, a, r.randrange(4), "ab")
        for tau in (1, 2, 3):
            assert line_dedup.within(a, b, tau) == (brute.edits(a, b) <= tau), (a, b, tau)


@pytest.mark.parametrize("group", [32, 2])
def test_classes_equal_comparing_every_pair(spark, monkeypatch, group):
    """Also with keys of more than two lines, which are verified in blocks."""
    monkeypatch.setattr(line_dedup, "JOINED_GROUP", group)
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", 3 if group == 2 else 256)
    docs = corpus()
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, line_no int")
    assert rows(line_dedup.line_classes(df)) == sorted(brute.line_classes(docs))
    kept = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(df).collect()}
    assert kept == brute.without_repeated_lines(docs)


def test_large_group_of_lines_that_share_segments(spark):
    r = random.Random(6)
    stem = "".join(r.choice("abcdef") for _ in range(120))
    docs = [(i, stem[:100] + "".join(r.choice("uvw") for _ in range(5)) + stem[100:]) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(line_dedup.line_classes(df)) == sorted(brute.line_classes(docs))


def test_repeated_rows_null_ids_counts_and_empty_tables(spark):
    line = "a line that is long enough to count"
    data = [(2, line + "\nshort", 41), (2, line + "\nshort", 41), (1, line[:-1] + "\nonly here in this document", 60), (None, line, 1), (2, "quite another text for this id", 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, n_chars long")
    got = sorted((r.doc_id or 0, r.text, r.n_chars) for r in line_dedup.drop_repeated_lines(df, count="n_chars").collect())
    assert got == [(1, data[2][1], 60), (2, "quite another text for this id", 1), (2, "short", 5), (2, "short", 5)]
    assert line_dedup.line_classes(df.limit(0)).count() == 0
    assert line_dedup.drop_repeated_lines(df.limit(0)).count() == 0


def test_a_very_long_line(spark):
    r = random.Random(8)
    line = "".join(r.choice("abcdefg ") for _ in range(300_000)) + "x"
    df = spark.createDataFrame([(1, line), (2, line[:1000] + "yy" + line[1000:]), (3, line[:50] + line[53:])], "doc_id long, text string")
    assert rows(line_dedup.line_classes(df)) == [(1, 0, 1, 0, 1), (2, 0, 1, 0, 1), (3, 0, 3, 0, 0)]


def rule_classes(docs, allowed):
    return sorted(brute.rule_classes(docs, allowed))


def short_corpus(seed=4):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdefgh ") for _ in range(n)).strip() for n in (1, 3, 6, 7, 8, 9, 12, 18, 19, 20, 21) for _ in range(2)]
    pool = base + [edited(r, r.choice(base), r.choice([1, 1, 2]), "abcdefgh") for _ in range(90)]
    return [(i, "\n".join(r.choice(["", " "]) + r.choice([*pool, ""]) for _ in range(r.randrange(6)))) for i in range(50)]


@pytest.mark.parametrize("group", [32, 2])
def test_short_lines_have_classes_and_links(spark, monkeypatch, group):
    """Lines of every length, also pairs of 19 and 20 characters."""
    monkeypatch.setattr(line_dedup, "JOINED_GROUP", group)
    docs = [*short_corpus(), (90, "of the day"), (91, "of the day"), (92, "nineteen characters"), (93, "nineteen charactersX"), (94, "abcdefg"), (95, "abcdefgh")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = rows(line_dedup.line_classes(df, tau=line_dedup.edits_allowed, min_chars=1))
    assert got == rule_classes(docs, line_dedup.edits_allowed)
    assert {(91, 0, 90, 0, 0), (93, 0, 92, 0, 1), (95, 0, 94, 0, 1)} <= set(got)


def test_short_lines_stay_only_beside_own_lines(spark):
    long, other = "a line that is long enough to count", "something else that no other document has"
    docs = [(1, f"By me\n{long}\nThe end"), (2, f"By me\n{long}\nThe end"), (3, f"By me\n{other}"), (4, f"By me\n{long}\nown")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = lambda n: {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(df, line_dedup.edits_allowed, 1, keep_under=n).collect()}
    assert kept(20) == {1: docs[0][1], 3: docs[2][1], 4: "By me\nown"}
    assert kept(0) == {1: docs[0][1], 3: other, 4: "own"}


def test_many_edits_equal_the_full_table():
    r = random.Random(2)
    for _ in range(3000):
        a = "".join(r.choice("abc") for _ in range(r.randrange(40)))
        b = edited(r, a, r.randrange(9), "abc")
        for tau in (3, 5, 8):
            assert line_dedup.within(a, b, tau) == (brute.edits(a, b) <= tau), (a, b, tau)


def test_there_are_more_separate_substrings_than_edits():
    """Every line that may have more than ``TAU`` edits holds enough substrings that don't overlap."""
    for n in [*range(1, 4000), *range(4000, 2_000_000, 39_989)]:
        if line_dedup._has_grams(line_dedup.edits_allowed, n):
            assert n // line_dedup.GRAM > line_dedup._limit(line_dedup.edits_allowed, n), n


def test_keys_of_long_lines():
    """Enough that don't overlap, the least hashes of the line, and every place of each."""
    r = random.Random(3)
    lines = ["".join(r.choice("ab cdé") for _ in range(n)) for n in (150, 151, 199, 700, 5000)]
    lines += ["a" * 400, "ab" * 200, "-" * 149 + "x"]
    needs = [line_dedup._limit(line_dedup.edits_allowed, len(s)) + 1 for s in lines]
    key, of, first, last = line_dedup.grams(lines, needs)
    for i, (line, need) in enumerate(zip(lines, needs)):
        high, low = (line_dedup._hashes([line], base).astype("uint64") for base in line_dedup._BASES)
        all_of_them = high * 2**32 + low
        own = key[of == i].view("uint64")
        assert len(set(own.tolist())) == len(own) and set(own.tolist()) == set(all_of_them[all_of_them <= own.max()].tolist())
        at = [p for p in range(len(all_of_them)) if all_of_them[p] <= own.max()]
        apart, end = 0, 0
        for p in at:
            if p >= end:
                apart, end = apart + 1, p + line_dedup.GRAM
        assert apart >= need
        for k, low, high in zip(own, first[of == i], last[of == i]):
            spots = [p for p in at if all_of_them[p] == k]
            assert (low, high) == (spots[0], spots[-1])


@pytest.mark.parametrize(("group", "held", "pairs"), [(32, 2048, 4), (2, 2048, 0), (2, 3, 0)])
def test_edits_grow_with_length(spark, monkeypatch, group, held, pairs):
    """Also with keys that are split, and with keys of which no task holds all lines."""
    monkeypatch.setattr(line_dedup, "JOINED_GROUP", group)
    monkeypatch.setattr(line_dedup, "HELD_LINES", held)
    monkeypatch.setattr(line_dedup, "PAIRS_A_LINE", pairs)
    r = random.Random(12)
    base = ["".join(r.choice("abcdefghij ") for _ in range(n)).strip() for n in (60, 146, 148, 150, 151, 210, 420)]
    pool = [edited(r, s, max(0, len(s) // 50 + r.choice([-1, 0, 0, 1])), "abcdefghij") for s in base for _ in range(7)]
    docs = list(enumerate(base + pool))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = rows(line_dedup.line_classes(df, tau=line_dedup.edits_allowed, min_chars=1))
    assert got == rule_classes(docs, line_dedup.edits_allowed)
    assert sum(r[4] > 0 for r in got) > sum(r[4] > 0 for r in rule_classes(docs, lambda n: 2))


def test_every_way_of_pairing_gives_the_same(spark, monkeypatch):
    """Lines around the border of 150 characters that share most of their segments, by pairs, split keys and blocks."""
    r = random.Random(17)
    stem = "".join(r.choice("abcdefgh ") for _ in range(240))
    docs = []
    for i in range(110):
        size = r.choice([20, 21, 60, 61, 148, 149, 150, 151, 153, 230])
        line = edited(r, stem[:size], r.randrange(6), "abcdefgh")
        docs.append((i, line.strip() + ("\n" + line if i % 9 == 0 else "")))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    want = rule_classes(docs, line_dedup.edits_allowed)
    for joined, held, pairs, block in ((32, 2048, 4, 256), (2, 2048, 0, 30), (2, 4, 0, 30), (32, 40, 1, 256)):
        for name, value in (("JOINED_GROUP", joined), ("HELD_LINES", held), ("PAIRS_A_LINE", pairs), ("BLOCK_LINES", block)):
            monkeypatch.setattr(line_dedup, name, value)
        assert rows(line_dedup.line_classes(df, tau=line_dedup.edits_allowed, min_chars=1)) == want, (joined, held)


def test_a_key_that_a_third_of_all_lines_share(spark):
    """20,000 lines, of which every third begins alike and has the same length; the job ends and finds its links."""
    r = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda n: "".join(r.choice(letters) for _ in range(n))
    lines = ["the same beginning as so many others, and " + word(40) if i % 3 == 0 else word(70) for i in range(20_000)]
    lines[9] = lines[6][:-1] + "#"
    lines[12] = lines[3][:50] + "#" + lines[3][50:]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = line_dedup.line_classes(df, tau=line_dedup.edits_allowed, min_chars=1)
    linked = sorted((x.doc_id, x.class_doc, x.n_links) for x in got.where("n_links > 0").collect())
    assert linked == [(3, 3, 1), (6, 6, 1), (9, 6, 1), (12, 3, 1)]


def test_only_live_stages_are_kept(spark, tmp_path, monkeypatch):
    """Two stages are left, which the result reads, and all others are gone when it is returned."""
    monkeypatch.setattr(stages, "scratch_path", lambda spark, label, folder=None: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    out = line_dedup.line_classes(df, tau=line_dedup.edits_allowed, min_chars=1)
    left = sorted(p.name.rsplit("-", 1)[0] for folder in tmp_path.iterdir() for p in folder.iterdir())
    assert left == ["classes", "lines"] and out.count() > 0


def test_pairs_looked_at_together_equal_the_full_table():
    """No pair within its edits is ruled out, and of others only those that 16 bits can't tell."""
    r = random.Random(21)
    a, b, edits = [], [], []
    for i in range(500):
        line = "".join(r.choice("abcdefgh é中") for _ in range(r.choice([64, 70, 150, 200, 333])))
        other = edited(r, line, r.choice([0, 1, 2, 3, 5, 8, 13, 20, 31, 33, 60]), "abcdefgh")
        if i % 5 == 0:
            # Moved words, and edits at both ends.
            other = other[9:] + other[:9] if i % 2 else "xx" + other[:-3]
        most = r.choice([3, 4, 7, 12, 31])
        if abs(len(line) - len(other)) <= most and min(len(line), len(other)) > 62:
            a.append(line)
            b.append(other)
            edits.append(most)
    got = line_dedup._can_be_within(a, b, edits)
    want = [brute.edits_up_to(x, y, t) for x, y, t in zip(a, b, edits)]
    assert got.tolist() == want and 50 < sum(want) < len(want) - 50
    assert line_dedup._can_be_within(["\U00010041" * 100], ["A" * 100], [3]).tolist() == [True]


def test_linked_pairs_equal_the_full_table():
    """Lines that come in many pairs, with edits up to the widest band and beyond, and characters of more than 16 bits."""
    r = random.Random(31)
    lines = []
    for letters in ("abcdefgh ", "abcdé 中\U0001f600", "".join(chr(0x4E00 + k) for k in range(400))):
        for n in (1, 2, 30, 64, 65, 130, 400):
            line = "".join(r.choice(letters) for _ in range(n))
            lines += [line] + [edited(r, line, r.randrange(n // 4 + 2), letters) for _ in range(5)]
    lines = sorted(set(lines) - {""})
    near = [(i, j) for i, x in enumerate(lines) for j, y in enumerate(lines) if i != j and abs(len(x) - len(y)) < 20]
    a, b = np.array(r.sample(near, 1200)).T
    for tau in (1, 2, lambda n: n // 12, lambda n: n // 5):
        edits = lambda i, j: tau if isinstance(tau, int) else tau(max(len(lines[i]), len(lines[j])))
        want = [k for k, (i, j) in enumerate(zip(a, b)) if brute.edits_up_to(lines[i], lines[j], edits(i, j))]
        assert line_dedup._linked(lines, a, b, tau).tolist() == want
        few = line_dedup._linked(lines, a[:40], b[:40], tau).tolist()
        assert few == [k for k in want if k < 40]
    assert len(want) > 50


def test_work_on_a_far_pair_grows_with_the_length(monkeypatch):
    """Two variants of one line of 6000 characters that are further apart than their 120 edits."""
    r, looked = random.Random(8), []
    alike = line_dedup._alike
    monkeypatch.setattr(line_dedup, "_alike", lambda *x: looked.append(0) or alike(*x))
    line = "".join(r.choice("abcdefghij ") for _ in range(6000))
    other = edited(r, line, 400, "abcdefghij")
    assert not line_dedup.within(line, other, 120)
    assert line_dedup.within(line, edited(r, line, 100, "abcdefghij"), 120)
    assert len(looked) < 6000


def test_a_line_comes_once_in_what_its_keys_connect(spark):
    """A family that shares many keys is one unit; of lines that are chained, every key is one."""
    family = [(key, line) for key in range(30) for line in range(100, 140) if (key + line) % 7]
    chain = [(1000 + key, 1000 + 39 * key + line) for key in range(30) for line in range(40)]
    first = {key: line for key, line in reversed([*family, *chain])}
    hot = spark.createDataFrame([(key, line, first[key]) for key, line in [*family, *chain]], "key long, id long, first long")
    with stages.Stages(spark, "test") as own:
        units = {}
        for u in line_dedup._units(hot, own).collect():
            units.setdefault((u.unit, u.whole, u.lines), []).append(u.id)
    assert {k: sorted(v) for k, v in units.items()} == {(100, True, 40): list(range(100, 140))} | {
        (1000 + key, False, 40): list(range(1000 + 39 * key, 1040 + 39 * key)) for key in range(30)
    }


@pytest.mark.parametrize("whole", [0, 4])
def test_units_of_keys_and_of_families_give_the_same(spark, monkeypatch, whole):
    r = random.Random(23)
    stems = ["".join(r.choice("abcdefgh ") for _ in range(n)).strip() for n in (60, 160, 420)]
    docs = [(i, edited(r, r.choice(stems), r.randrange(9), "abcdefgh").strip()) for i in range(90)]
    for name, value in (("JOINED_GROUP", 2), ("PAIRS_A_LINE", 0), ("BLOCK_LINES", 20), ("WHOLE", whole), ("_FEW", 5)):
        monkeypatch.setattr(line_dedup, name, value)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = rows(line_dedup.line_classes(df, tau=line_dedup.edits_allowed, min_chars=1))
    assert got == rule_classes(docs, line_dedup.edits_allowed)
    assert sum(r[4] > 0 for r in got) > 20
