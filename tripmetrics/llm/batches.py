"""Arrow batches in tasks: bounded slices and raw UTF-8 texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# A slice holds at most this many bytes of text, or one text that is longer.
SLICE_BYTES = 4 << 20
_RUNS = 1 << 16


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of a slice stay within ``limit`` bytes. Empty batches go."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; a null text is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``start, start + 1, ...`` of every run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def gather(source: np.ndarray, starts: np.ndarray, lengths: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of a table of runs of ``source``, the runs ``rows``, one after the other; positions of ``_RUNS`` are held at a time."""
    parts = [rows[i : i + _RUNS] for i in range(0, len(rows), _RUNS)]
    out = np.empty(sum(int(lengths[p].sum()) for p in parts), source.dtype)
    at = 0
    for part in parts:
        positions = ragged(starts[part], lengths[part])
        # Positions are in bounds; without a mode numpy would copy them once more.
        np.take(source, positions, out=out[at : at + len(positions)], mode="clip")
        at += len(positions)
    return out


def free_name(name: str, df: DataFrame) -> str:
    """``name``, with underscores behind it until no column of ``df`` is called so; case doesn't matter to Spark."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def extended(df: DataFrame, added: str) -> StructType:
    """The schema of ``df`` and then columns given as DDL."""
    return StructType([*df.schema.fields, *StructType.fromDDL(added).fields])
