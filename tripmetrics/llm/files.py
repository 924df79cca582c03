"""Files in the shared folder that tasks write and read themselves, on any store that Arrow knows."""

from __future__ import annotations

import uuid

import pyarrow.fs
from pyspark import TaskContext


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store of a path or URI, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(uri)


def attempt_name(label: str) -> str:
    """A file name that no other attempt of this or another task takes.

    Readers learn names from rows that Spark commits, so what a lost or repeated attempt leaves is never read.
    """
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    return f"{label}-{part:06d}-{uuid.uuid4().hex}"
