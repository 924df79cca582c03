from __future__ import annotations

import random
import time

import pytest

from tripmetrics.llm.url_filter import UrlTrie, judge_urls, split_url

RULES = [("org/", "allow"), ("b.org/x/", "block"), ("b.org/x/1", "allow"), ("org", "block"), ("A.b.org/x", "block"), ("com/", "block"), ("com/", "allow")]


def slow(url, rules, default="allow"):
    host, path = split_url(url)
    best = None
    for rule, verdict in rules:
        rule_host, slash, rest = (rule or "").partition("/")
        rule_host = rule_host.lower()
        if rule_host and (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rest):
            rank = (rule_host.count("."), len(rest) + len(slash), verdict == "block")
            best = max(best or rank + ("",), rank + (rule,))
    return (host, path, best[3], "block" if best[2] else "allow") if best else (host, path, None, default)


def urls():
    r = random.Random(3)
    hosts = ["org", "b.org", "a.b.org", "A.B.ORG", "xb.org", "com", "q.com", "net", "", "b.org:80"]
    paths = ["", "/", "/x", "/x/", "/x/1", "/x/12/3", "/x/2", "//", "/y?x=/x/1", "?q", "#/x/"]
    made = [f"{r.choice(['http', 'https', ''])}://{r.choice(hosts)}{r.choice(paths)}" for _ in range(300)]
    return [*made, None, "", "org/x", "http:/org/", "a://b://org/", "http://é.org/ü"]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_equals_trying_every_rule(spark, limit):
    rows = [(i, u) for i, u in enumerate(urls())]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = spark.createDataFrame([*RULES, (None, "block"), ("/x", "block")], "rule string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules, max_trie_bytes=limit).collect()}
    assert got == {i: slow(u, RULES) for i, u in rows}


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_clashing_columns_repeated_rows_and_empty_tables(spark, limit):
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    pages = spark.createDataFrame([("http://com/", "old", 1)] * 2, "url string, host string, rule int")
    got = judge_urls(pages, rules, max_trie_bytes=limit)
    assert sorted(got.columns) == ["host", "path", "rule", "url", "verdict"]
    assert [(r.host, r.verdict) for r in got.collect()] == [("com", "block")] * 2
    assert judge_urls(pages.limit(0), rules, max_trie_bytes=limit).count() == 0
    assert {r.verdict for r in judge_urls(pages, rules.limit(0), max_trie_bytes=limit, default="block").collect()} == {"block"}


def test_longest_entry_wins_over_shorter_of_either_kind():
    trie = UrlTrie(RULES)
    assert trie.match("b.org", "/x/1") == ("b.org/x/1", "allow")
    assert trie.match("b.org", "/x/2") == ("b.org/x/", "block")
    assert trie.match("net", "/") is None


@pytest.mark.parametrize("limit", [1 << 20, 0])
@pytest.mark.parametrize("turn", [1, -1])
def test_rules_that_say_the_same_have_one_answer(spark, limit, turn):
    """Block before allow, then the greatest rule text, in either form and whatever the order of the rules."""
    rules = [("Org/", "allow"), ("org/", "allow"), ("oRG/a", "block"), ("org/a", "allow"), ("b.ORG/", "block"), ("B.org/", "block")][::turn]
    pages = spark.createDataFrame([(1, "http://x.org/"), (2, "http://org/abc"), (3, "http://b.org/q")], "page_id long, url string")
    found = judge_urls(pages, spark.createDataFrame(rules, "rule string, verdict string"), max_trie_bytes=limit)
    assert {r.page_id: (r.rule, r.verdict) for r in found.collect()} == {1: ("org/", "allow"), 2: ("oRG/a", "block"), 3: ("b.ORG/", "block")}


def test_many_rules_in_one_folder_and_very_many_labels(spark):
    rules = [(f"example.org/folder/{i:06d}", "block") for i in range(100_000)] + [("example.org/folder/", "allow"), ("example.org/folder/00004", "allow")]
    trie = UrlTrie(rules)
    began = time.perf_counter()
    for i in range(2000):
        assert trie.match("www.example.org", f"/folder/{i:06d}x") == (f"example.org/folder/{i:06d}", "block")
        assert trie.match("example.org", "/folder/x") == ("example.org/folder/", "allow")
    assert (time.perf_counter() - began) / 4000 < 1e-4
    assert trie.match("example.org", "/folder/00004") == ("example.org/folder/00004", "allow")
    host = ".".join(["a"] * 12_000)
    pages = spark.createDataFrame([(1, f"http://x.{host}/")], "page_id long, url string")
    rules = spark.createDataFrame([(host + "/", "block")], "rule string, verdict string")
    for limit in (1 << 20, 0):
        assert [r.verdict for r in judge_urls(pages, rules, max_trie_bytes=limit).collect()] == ["block"]
