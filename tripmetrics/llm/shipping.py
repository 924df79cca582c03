"""Sends this package to the workers of a session, for callers that don't do so with ``--py-files``."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Once per application, add the sources as an archive that Spark hands to every worker."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    top = Path(__file__).resolve().parents[2]
    path = os.path.join(tempfile.mkdtemp(prefix="tripmetrics-"), "tripmetrics-sources.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted((top / "tripmetrics").rglob("*.py")):
            archive.write(source, source.relative_to(top))
    context.addPyFile(path)
    _SENT.add(context.applicationId)


def shipped(query: Callable) -> Callable:
    """A function of a session first, which sends the package before it runs."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        send_package(spark)
        return query(spark, *args)

    return run
