"""WARC archives with an index that is merged from sorted runs.

Every task writes gzip-per-record archives into a folder that all executors reach, and for each archive a run
of index entries sorted by URL key and timestamp. The runs are ranged by key over tasks; each task lays its
slices of the runs down in a file in the shared folder and merges them with a loser tree, reading a batch of each at a
time. The partitions of the merged index follow each other in order, so together they are globally ordered
capture histories. A URL that holds very many captures is split over tasks by its timestamps.

Of records with equal payloads of at least ``min_bytes``, the one with the largest page id is a response and
the others are revisits that refer to it; smaller ones are all responses.

Results for odd input: a null payload is empty; a null URL has an empty key and comes first; a null id is
written as an empty one, is the smallest and is read back as null. Rows that share the largest id are all
responses, and so are all rows of a payload that has only null ids. Repeated rows are repeated records. An
empty table gives no archives. Other columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import zlib
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.files import attempt_name, filesystem
from tripmetrics.llm.url_filter import split_url
from tripmetrics.sources import scratch_path, stage

MIN_BYTES = 1000
# An archive is closed beyond this size or number of records.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 256 << 20, 100_000
_BATCH = 4096
# What a date of four digits can name, in seconds since 1970.
_FIRST_SECOND, _LAST_SECOND = -62_135_596_800, 253_402_300_799
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = "url_key string, timestamp string, page_id bigint, record_type string, file string, offset bigint, length bigint"
_ARROW_INDEX = pa.schema(
    [
        ("url_key", pa.string()),
        ("timestamp", pa.string()),
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
    ]
)
_RECORDS = (
    "page_id bigint, url string, timestamp string, record_type string, refers_to bigint, "
    "payload_bytes bigint, payload_digest string, payload binary"
)


def url_key(url: str | None) -> str:
    """The host's labels from the top down, then the rest of the URL in lower case."""
    host, _ = split_url(url)
    rest = (url or "").partition("://")[2][len(host) :]
    return ",".join(reversed(host.split("."))) + ")" + rest.lower() if host else (url or "").lower()


# Records


def _header_text(value: str) -> str:
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def make_record(page_id: int | None, url: str | None, stamp: str, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member: a response, or with ``refers_to`` a revisit, which leaves the payload out."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {stamp}",
        f"WARC-Target-URI: {_header_text(url or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is None:
        block += payload
    else:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_REVISIT}"]
    lines.append(f"Content-Length: {len(block)}")
    return _member("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def _member(raw: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {name.lower(): value.strip() for name, _, value in pairs}


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse_record(member: bytes) -> dict:
    """What a response or revisit says. A response's digest is taken from its payload and must be the header's."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = _fields(head)
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    noted = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    size = int(_fields(http)["content-length"])
    if fields["warc-type"] == "response" and (hashlib.sha1(payload).hexdigest() != noted or len(payload) != size):
        raise ValueError(f"damaged payload in record {fields['warc-record-id']}")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "url": fields["warc-target-uri"],
        "timestamp": fields["warc-date"],
        "record_type": fields["warc-type"],
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload_bytes": size,
        "payload_digest": noted,
        "payload": payload if fields["warc-type"] == "response" else None,
    }


# Writing


class _Archive:
    """An archive being written, with the run of its index entries."""

    def __init__(self, folder: str):
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        self.name = attempt_name("pages") + ".warc.gz"
        self.out = store.open_output_stream(f"{root}/{self.name}", compression=None)
        self.size, self.run = 0, []
        stamp = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        info = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:file:{self.name}>\r\nWARC-Date: {stamp}\r\n"
        self._write(_member(info.encode() + b"Content-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n"))

    def _write(self, member: bytes) -> None:
        self.out.write(member)
        self.size += len(member)

    def add(self, page_id: int | None, url: str | None, stamp: str, payload: bytes, refers_to: int | None) -> None:
        member = make_record(page_id, url, stamp, payload, refers_to)
        kind = "response" if refers_to is None else "revisit"
        self.run.append((url_key(url), stamp, page_id, kind, self.name, self.size, len(member)))
        self._write(member)

    def close(self) -> Iterator[pa.RecordBatch]:
        self.out.close()
        self.run.sort(key=_order)
        for i in range(0, len(self.run), _BATCH):
            columns = zip(*self.run[i : i + _BATCH])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW_INDEX)], schema=_ARROW_INDEX)


def _order(entry: tuple) -> tuple:
    """URL key, timestamp, then archive and place, which no two entries share."""
    return entry[0], entry[1], entry[4], entry[5]


def find_responses(pages: DataFrame, page_id: str, payload: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``_digest`` and ``_response``, the largest id, of the payloads that several pages share.

    Only digests and ids are shuffled, combined on the map side; the result is staged, so the planner knows its size.
    """
    long_ones = pages.where(F.octet_length(payload) >= min_bytes).groupBy(F.sha1(payload).alias("_digest"))
    shared = long_ones.agg(F.max(page_id).alias("_response"), F.count("*").alias("n")).where("n > 1")
    return stage(shared.select("_digest", "_response"), "warc-responses")


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    timestamp: Column | None = None,
    min_bytes: int = MIN_BYTES,
) -> DataFrame:
    """Write the pages to ``folder`` and return the staged index runs.

    ``timestamp`` is the capture time in seconds since 1970; times before the year 1 and after 9999 count as the first
    and the last second that a date can name. Where none is given, the time is the page id modulo the seconds from 1970
    to the end of 9999.
    """
    responses = find_responses(pages, page_id, payload, min_bytes)
    if timestamp is None:
        seconds = F.pmod(F.col(page_id).cast("bigint"), F.lit(_LAST_SECOND + 1))
    else:
        seconds = F.greatest(F.least(timestamp.cast("bigint"), F.lit(_LAST_SECOND)), F.lit(_FIRST_SECOND))
    wide = pages.select(
        F.col(page_id).cast("bigint").alias("id"),
        F.col(url).alias("url"),
        F.encode(payload, "UTF-8").alias("payload"),
        F.coalesce(seconds, F.lit(0)).alias("seconds"),
        F.when(F.octet_length(payload) >= min_bytes, F.sha1(payload)).alias("_digest"),
    ).join(responses, "_digest", "left")
    refers = F.when(~F.col("id").eqNullSafe(F.col("_response")), F.col("_response")).alias("refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                archive = archive or _Archive(folder)
                number, address, raw, second, refers_to = row
                stamp = f"{(datetime(1970, 1, 1) + timedelta(seconds=second)).isoformat()}Z"
                archive.add(number, address, stamp, raw or b"", refers_to)
                if archive.size >= ARCHIVE_BYTES or len(archive.run) >= ARCHIVE_RECORDS:
                    yield from archive.close()
                    archive = None
        if archive:
            yield from archive.close()

    return stage(wide.select("id", "url", "payload", "seconds", refers).mapInArrow(write, _INDEX), "warc-runs")


# The index


class LoserTree:
    """Merges sorted iterators: inner nodes hold who lost there, the winner of all is on top."""

    def __init__(self, runs: Iterable[Iterator], key: Callable):
        self.runs, self.key = [iter(r) for r in runs], key
        self.heads: list = [None] * len(self.runs)
        self.keys: list = [None] * len(self.runs)
        self.width = max(1, len(self.runs))
        self.losers = [-1] * self.width
        for i in range(len(self.runs)):
            self._advance(i)
        for i in range(len(self.runs)):
            self._play(i, True)

    def _advance(self, i: int) -> None:
        self.heads[i] = next(self.runs[i], None)
        self.keys[i] = None if self.heads[i] is None else self.key(self.heads[i])

    def _beats(self, i: int, j: int) -> bool:
        if self.keys[i] is None or self.keys[j] is None:
            return self.keys[j] is None and self.keys[i] is not None
        return self.keys[i] < self.keys[j]

    def _play(self, i: int, first: bool = False) -> None:
        """Play from leaf ``i`` up. While the tree is filled, the first to reach a node waits there."""
        node = (i + self.width) // 2
        while node:
            other = self.losers[node]
            if other < 0 and first:
                self.losers[node] = i
                return
            if other >= 0 and self._beats(other, i):
                self.losers[node], i = i, other
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator:
        while self.runs and self.heads[self.losers[0]] is not None:
            winner = self.losers[0]
            yield self.heads[winner]
            self._advance(winner)
            self._play(winner)


def merge_runs(runs: DataFrame) -> DataFrame:
    """The entries of all runs in global order: by URL key and timestamp within and across partitions."""
    order = ["url_key", "timestamp", "file", "offset"]
    ranged = runs.repartitionByRange(*order).sortWithinPartitions("file", *order)
    folder = scratch_path(runs.sparkSession, "warc-merge")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        path, places, count = f"{root}/{attempt_name('runs')}", {}, 0
        with store.open_output_stream(path) as out, pa.ipc.new_file(out, _ARROW_INDEX) as laid:
            for piece in _one_run_each(itertools.chain([first], batches)):
                laid.write_batch(piece)
                places.setdefault(piece.column("file")[0].as_py(), []).append(count)
                count += 1
        with store.open_input_file(path) as source:
            slices = pa.ipc.open_file(source)
            tree = LoserTree([_rows(slices, numbers) for numbers in places.values()], _order)
            merged: list[tuple] = []
            for entry in tree:
                merged.append(entry)
                if len(merged) == _BATCH:
                    yield _entries(merged)
                    merged = []
            if merged:
                yield _entries(merged)
        store.delete_file(path)

    return ranged.mapInArrow(merge, _INDEX)


def _one_run_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        files = batch.column("file").to_pylist()
        start = 0
        for i in range(1, len(files) + 1):
            if i == len(files) or files[i] != files[start] or i - start == _BATCH:
                yield pa.RecordBatch.from_arrays(batch.slice(start, i - start).columns, schema=_ARROW_INDEX)
                start = i


def _rows(slices: pa.ipc.RecordBatchFileReader, numbers: list[int]) -> Iterator[tuple]:
    for number in numbers:
        yield from zip(*(c.to_pylist() for c in slices.get_batch(number).columns))


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW_INDEX)], schema=_ARROW_INDEX)


# Reading


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """The records that the index lists, each archive read from front to back."""
    # As many parts as archives: an index is small, and adaptive execution would join its rows to few tasks.
    archives = index.agg(F.count_distinct("file")).first()[0]
    placed = index.select("file", "offset", "length").repartition(max(1, archives), "file")
    placed = placed.sortWithinPartitions("file", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        name, source = None, None
        for batch in batches:
            rows, size = [], 0
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if file != name:
                    name, source = file, store.open_input_file(f"{root}/{file}")
                source.seek(offset)
                rows.append(parse_record(source.read(length)))
                size += len(rows[-1]["payload"] or b"")
                if size > 16 << 20:
                    yield _records(rows)
                    rows, size = [], 0
            if rows:
                yield _records(rows)

    return placed.mapInArrow(read, _RECORDS)


def _records(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names = [c.split() for c in _RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[k]) for n, k in names], [n for n, _ in names])


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write archives to a new scratch folder, merge their index, and read back what it lists."""
    folder = scratch_path(pages.sparkSession, "warc")
    index = stage(merge_runs(write_archives(pages, folder)), "warc-index")
    return read_archives(index, folder)
