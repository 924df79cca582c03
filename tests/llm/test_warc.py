from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from tripmetrics.llm import warc


def pages():
    r = random.Random(7)
    payloads = ["é" * 500, "x" * 1000, "x" * 999, "", None, "long " * 5000]
    rows = [(i, f"http://h{r.randrange(4)}.example.org/{r.randrange(9)}?Q={i % 3}", r.choice(payloads)) for i in range(120)]
    return rows + [(None, "http://a.b/", "x" * 1000), (None, None, "solo" * 400), (119, "http://a b/\r\né", "y" * 2000), (119, "no scheme", "y" * 2000), (5, "", "y" * 2000)]


def expected(rows):
    best = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 1000 and page is not None:
            best[raw] = max(best.get(raw, page), page)
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        first = best.get(raw)
        other = first if first is not None and first != page else None
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "response" if other is None else "revisit", other))
    return sorted(out, key=str)


def test_what_is_read_back(spark):
    rows = pages()
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string").repartition(5)
    got = warc.archive_and_read(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)
    assert warc.archive_and_read(df.limit(0)).count() == 0


def test_the_index_is_in_global_order_and_finds_every_record(spark, tmp_path):
    rows = pages()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    runs = warc.write_archives(df, f"file://{tmp_path}/w", timestamp=F.col("page_id") % 7)
    assert runs.select("file").distinct().count() > 1
    merged = warc.merge_runs(runs)
    got = merged.withColumn("p", F.spark_partition_id()).withColumn("i", F.monotonically_increasing_id()).collect()
    entries = [(r.url_key, r.timestamp, r.file, r.offset) for r in sorted(got, key=lambda r: (r.p, r.i))]
    assert entries == sorted(entries)
    assert sorted(entries) == sorted((r.url_key, r.timestamp, r.file, r.offset) for r in runs.collect())
    read = warc.read_archives(merged, f"file://{tmp_path}/w").collect()
    assert sorted(r.payload or b"" for r in read if r.record_type == "response") == sorted(
        (h or "").encode() for (p, _, h), e in zip(rows, [x for x in _in_input_order(rows)]) if e == "response"
    )


def _in_input_order(rows):
    kinds = {(r[0], r[2]): r[3] for r in expected(rows)}
    return [kinds[page, hashlib.sha1((html or "").encode()).hexdigest()] for page, _, html in rows]


def test_every_id_and_time_has_a_date(spark, tmp_path):
    """Least and greatest long, hashed ids, and the first id beyond the dates of four digits."""
    ids = [-(2**63), 2**63 - 1, 253402300799, 253402300800, 300000000000, -1, 0, None, 8111222333444555666]
    rows = [(i, f"http://a.b/{n}", "x" * 1500 if n % 2 else str(n)) for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    records = warc.archive_and_read(df)
    got = records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)
    stamps = {r.page_id: r.timestamp for r in records.collect()}
    assert stamps[253402300799] == "9999-12-31T23:59:59Z" and stamps[253402300800] == "1970-01-01T00:00:00Z"
    runs = warc.write_archives(df, f"file://{tmp_path}/w", timestamp=F.col("page_id"))
    given = {r.page_id: r.timestamp for r in runs.collect()}
    assert given[2**63 - 1] == "9999-12-31T23:59:59Z" and given[-(2**63)] == "0001-01-01T00:00:00Z"


def test_loser_tree_equals_sorting():
    r = random.Random(1)
    for k in range(12):
        runs = [sorted(r.randrange(50) for _ in range(r.randrange(9))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for run in runs for x in run)


def test_url_keys():
    assert warc.url_key("https://Www.Example.org:8/A?b#c") == "org:8,example,www)/a?b#c"
    assert warc.url_key("plain") == "plain" and warc.url_key(None) == ""
