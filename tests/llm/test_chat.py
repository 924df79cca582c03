from __future__ import annotations

import random

import pytest

from tripmetrics.llm import chat


def conversations():
    r = random.Random(6)
    turn = lambda i: (i, r.choice(["user", "assistant"]), r.choice(["hi", "a <|end|> b", "", "é\n"]))
    rows = []
    for c in range(0, 90, 3):
        turns = [turn(i) for i in range(r.randrange(1, 7))]
        rows += [(c, *t) for t in turns]
        rows += [(c + 1, *t) for t in turns[: r.randrange(1, len(turns) + 1)]]
        rows += [(c + 2, *t) for t in turns[:-1]] + [(c + 2, 9, "user", str(c))]
    return rows + [(200, 0, None, None), (201, 0, "", None), (202, None, "user", "x"), (202, 1, "user", "y"), (203, None, "user", "x"), (None, 0, "user", "z"), (204, 0, "user", "z"), (204, 0, "user", "z"), (205, 0, "b", "t"), (205, 0, "a", "t"), (205, 0, "a", "s"), (206, -5, "u", "v"), (207, -5, "u", "v"), (207, 3000, "u", "w")]


def slow(rows):
    by = {}
    for c, t, role, text in set(rows):
        by.setdefault(c, set()).add((t, role, text))
    whole = {c: frozenset(v) for c, v in by.items()}
    rank = lambda t: (t is not None, t or 0)
    parts = set()
    for c, v in by.items():
        turns = sorted({t for t, _, _ in v}, key=rank)
        for t in turns[:-1]:
            parts.add(frozenset(x for x in v if rank(x[0]) <= rank(t)))
    out = {}
    for c, v in whole.items():
        first = min((k for k in whole if whole[k] == v), key=lambda k: (k is None, k or 0))
        if v in parts or c != first:
            continue
        mark = lambda s: (s or "").replace("<|", "<\\|")
        ordered = sorted(v, key=lambda x: (rank(x[0]), (x[1] is not None, x[1] or ""), (x[2] is not None, x[2] or "")))
        out[c] = (len(v), "".join(f"<|{mark(role)}|>\n{mark(text)}\n<|end|>\n" for _, role, text in ordered))
    return out


@pytest.mark.parametrize("block", [1024, 2])
def test_equals_comparing_sets(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK_TURNS", block)
    rows = conversations()
    df = spark.createDataFrame([(*x, 1) for x in rows], "conv_id long, turn long, role string, text string, block int")
    got = {}
    for r in sorted(chat.format_chats(df).collect(), key=lambda r: (r.conv_id or -1, r.part)):
        n, text = got.get(r.conv_id, (0, ""))
        got[r.conv_id] = (n + r.n_rows, text + r.rendered)
    assert got == slow(rows)
    assert chat.format_chats(df.limit(0)).count() == 0


def test_a_very_large_conversation_comes_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_TURNS", 8)
    monkeypatch.setattr(chat, "PART_ROWS", 20)
    rows = [(1, i, "user", f"t{i}") for i in range(50)] + [(1, 3, "user", f"same turn {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(chat.format_chats(df).collect(), key=lambda r: r.part)
    assert [r.part for r in got] == list(range(len(got))) and max(r.n_rows for r in got) < 60
    said = [line for r in got for line in r.rendered.split("\n") if line[:1] == "t" or line[:1] == "s"]
    assert len(said) == 250 and [s for s in said if s[0] == "t"] == [f"t{i}" for i in range(50)]
    assert said.index("t2") < said.index("same turn 0") < said.index("t4")


def test_parts_are_bounded_in_bytes_and_numbered_by_their_keys(spark, monkeypatch):
    """The window that numbers parts sees no text."""
    monkeypatch.setattr(chat, "PART_BYTES", 5000)
    rows = [(1, i, "user", f"t{i} " + "x" * 900) for i in range(60)] + [(2, 0, "user", "short")] + [(None, 0, "user", "y" * 7000), (None, 1, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(df)
    got = sorted((r for r in out.collect() if r.conv_id == 1), key=lambda r: r.part)
    assert [r.part for r in got] == list(range(len(got))) and len(got) > 10 and max(len(r.rendered) for r in got) < 12_000
    assert [line.split()[0] for r in got for line in r.rendered.split("\n") if line[:1] == "t"] == [f"t{i}" for i in range(60)]
    assert sorted((r.part, r.n_rows) for r in out.collect() if r.conv_id is None) == [(0, 1), (1, 1)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Window [" in line and "rendered" in line]
