"""URL filters: allow and block entries in a trie over reversed host labels and path segments.

An entry is ``host/path``. It fits its host and every subdomain of it if the URL's path starts with the
entry's path. Of several that fit, the one with most host labels wins, then the one with the longest path,
whether it allows or blocks. The same entry given as both blocks.

Results for odd input: a null URL, an empty one and one without ``://`` have an empty host and path, fit no
entry and get the default verdict. Repeated rows are judged one by one; null rules and rules without a host
are left out. Output columns replace columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.batches import extended

ALLOW, BLOCK = "allow", "block"
# Rule text up to this size is sent to every executor as a trie; more rules are joined.
MAX_TRIE_BYTES = 8 << 20
_HOST_END = re.compile(r"[/?#]")
_PATH_END = re.compile(r"[?#]")
_UPPER_TO_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host, A-Z lower-cased, and path; both empty where there is no ``://``."""
    if url is None:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    end = _HOST_END.search(rest)
    cut = end.start() if end else len(rest)
    path = _PATH_END.split(rest[cut:], maxsplit=1)[0]
    return rest[:cut].translate(_UPPER_TO_LOWER), path


class UrlTrie:
    """Longest match of a host and path among the entries."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root: dict = {}
        for rule, verdict in rules:
            host, slash, path = (rule or "").partition("/")
            if not host:
                continue
            node = self.root
            for label in reversed(host.translate(_UPPER_TO_LOWER).split(".")):
                node = node.setdefault(label, {})
            self._add_path(node.setdefault("/", {}), slash + path, rule, verdict)

    @staticmethod
    def _add_path(node: dict, path: str, rule: str, verdict: str) -> None:
        """Whole segments are inner nodes; the rest of the path is a beginning of the next segment."""
        segments = path.split("/")
        for segment in segments[:-1]:
            node = node.setdefault(segment, {})
        starts, start = node.setdefault("/", {}), segments[-1]
        lengths = node.setdefault("//", [])
        if start not in starts:
            if len(start) not in lengths:
                lengths.append(len(start))
                lengths.sort(reverse=True)
            starts[start] = (rule, verdict)
        else:
            # Of rules that say the same of a host and path, block before allow, then the greatest text.
            starts[start] = max(starts[start], (rule, verdict), key=lambda x: (x[1], x[0]))

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        found = []
        node = self.root
        for label in reversed(host.split(".")) if host else ():
            node = node.get(label)
            if node is None:
                break
            if "/" in node:
                found.append(node["/"])
        segments = path.split("/")
        for paths in reversed(found):
            best = self._longest(paths, segments)
            if best:
                return best
        return None

    @staticmethod
    def _longest(node: dict, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            starts = node.get("/")
            if starts:
                # One look a length: rules of one folder have few different ones, however many they are.
                fitting = (starts.get(segment[:n]) for n in node["//"] if n <= len(segment))
                best = next(filter(None, fitting), best)
            node = node.get(segment)
            if node is None:
                break
        return best


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = ALLOW,
    max_trie_bytes: int = MAX_TRIE_BYTES,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to ``pages``.

    ``rules`` has the columns ``rule`` and ``verdict``. Their size is measured first: up to
    ``max_trie_bytes`` of rule text a trie goes to every executor, beyond it URLs and rules are joined.
    """
    size = rules.agg(F.coalesce(F.sum(F.octet_length("rule") + 64), F.lit(0))).first()[0]
    judge = _by_trie if size <= max_trie_bytes else _by_join
    return judge(pages, rules, url, default)


def _by_trie(pages: DataFrame, rules: DataFrame, url: str, default: str) -> DataFrame:
    sent = pages.sparkSession.sparkContext.broadcast([(r.rule, r.verdict) for r in rules.select("rule", "verdict").collect()])
    names = ("host", "path", "rule", "verdict")
    kept = pages.drop(*names) if url not in names else pages.drop(*(n for n in names if n != url))
    schema = extended(kept, ", ".join(f"{n} string" for n in names))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(tuple(sent.value))
        for batch in batches:
            parts = [split_url(u) for u in batch.column(url).to_pylist()]
            verdicts = [trie.match(*p) or (None, default) for p in parts]
            added = [*zip(*parts)] + [*zip(*verdicts)] if parts else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(a, pa.string()) for a in added)], [*batch.schema.names, *names]
            )

    return kept.mapInArrow(judge, schema)


_TRIES: dict[tuple, UrlTrie] = {}


def _trie(rules: tuple) -> UrlTrie:
    """One trie per Python worker and set of rules."""
    if rules not in _TRIES:
        _TRIES.clear()
        _TRIES[rules] = UrlTrie(rules)
    return _TRIES[rules]


def _by_join(pages: DataFrame, rules: DataFrame, url: str, default: str) -> DataFrame:
    """Every host suffix and every path beginning of a rule's length is a key; equal keys meet in a join."""
    lower = lambda c: F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    entries = (
        rules.select(
            "rule",
            "verdict",
            lower(F.split_part("rule", F.lit("/"), F.lit(1))).alias("_host"),
            F.expr("substring(rule, char_length(split_part(rule, '/', 1)) + 1)").alias("_start"),
        )
        .where("_host <> ''")
        .groupBy("_host", "_start")
        .agg(F.max(F.struct("verdict", "rule")).alias("_entry"))
    )
    lengths = F.array_sort(F.collect_set(F.char_length("_start")))
    lengths = entries.agg(lengths.alias("n")).first()["n"]
    rest = F.expr("substring(_url, locate('://', _url) + 3)")
    urls = (
        pages.select(F.col(url).alias("_url"))
        .where("locate('://', _url) > 0")
        .distinct()
        .withColumn("_rest", rest)
        .withColumn("_host", lower(F.regexp_extract("_rest", r"^([^/?#]*)", 1)))
        .withColumn("_path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1))
    )
    suffixes = F.expr(
        "transform(sequence(1, size(split(_host, '[.]'))), "
        "i -> struct(size(split(_host, '[.]')) - i + 1 AS labels, array_join(slice(split(_host, '[.]'), i, size(split(_host, '[.]'))), '.') AS host))"
    )
    starts = F.transform(
        F.filter(F.lit(lengths), lambda n: n <= F.char_length("_path")), lambda n: F.substring(F.col("_path"), 1, n)
    )
    keys = urls.select("_url", "_path", F.explode(suffixes).alias("_s")).select("_url", "_s", F.explode(starts).alias("_start"))
    keys = keys.select("_url", F.col("_s.labels").alias("_labels"), F.col("_s.host").alias("_host"), "_start")
    best = (
        keys.join(entries, ["_host", "_start"])
        .groupBy("_url")
        .agg(F.max(F.struct("_labels", F.char_length("_start").alias("_n"), "_entry")).alias("_best"))
    )
    parts = F.when(F.locate("://", url) > 0, F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")).otherwise("")
    out = pages.withColumn("_rest", F.coalesce(parts, F.lit("")))
    out = out.withColumns(
        {
            "_h": lower(F.regexp_extract("_rest", r"^([^/?#]*)", 1)),
            "_p": F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1),
        }
    )
    joined = out.join(best, F.col(url).eqNullSafe(F.col("_url")), "left")
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict") or c == url]
    return joined.select(
        *kept,
        F.col("_h").alias("host"),
        F.col("_p").alias("path"),
        F.col("_best._entry.rule").alias("rule"),
        F.coalesce("_best._entry.verdict", F.lit(default)).alias("verdict"),
    )
