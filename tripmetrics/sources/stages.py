"""Parquet stage tables: parse and clean once, then query the typed columns.

A stage is also how this library cuts lineage and how the planner learns the real size of a small
table: files have a known size, so a join with a stage becomes a broadcast join only while the stage is
below ``spark.sql.autoBroadcastJoinThreshold``, and a sort-merge join with skew handling above it.

A computation of several steps keeps its scratch stages in a ``Stages`` scope, which removes each of them as soon as
what was made from it is written.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from types import TracebackType

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Beside the data of a partitioned stage; readers skip names that begin with an underscore.
_SCHEMA = "_schema"


def save_stage(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    mode: str = "overwrite",
    rebalance: bool = True,
    sort_by: tuple[str, ...] = (),
    look_up: tuple[str, ...] = (),
) -> None:
    """Write a stage table.

    ``sort_by`` puts the rows of each file in order, so that row groups hold narrow ranges of these columns and a
    filter on them skips most by their least and greatest value. ``look_up`` names columns that are searched for one
    value: they get Bloom filters, or dictionaries where their values are few, and row groups without the value are
    skipped.

    With ``partition_by`` the rows are rebalanced on that column first. Without this every task would
    write a small file into every folder; with it adaptive execution splits a folder that holds a large
    share of all rows over many tasks and joins small ones. The rows are shuffled once for this; turn
    ``rebalance`` off for input that already lies in that column's order.
    """
    search = {f"parquet.bloom.filter.enabled#{c}": "true" for c in look_up}
    if partition_by is None:
        rows = df.sortWithinPartitions(*sort_by) if sort_by else df
        rows.write.mode(mode).options(**search).parquet(path)
        return
    rows = df.hint("rebalance", partition_by) if rebalance else df
    if sort_by:
        rows = rows.sortWithinPartitions(partition_by, *sort_by)
    rows.write.mode(mode).options(**search).partitionBy(partition_by).parquet(path)
    # Folder names are text; without this their type would be guessed, and a taxi 007 come back as 7.
    types = df.sparkSession.createDataFrame([(df.schema.json(),)], "value string")
    types.coalesce(1).write.mode("overwrite").text(f"{path}/{_SCHEMA}")


def load_stage(spark: SparkSession, path: str) -> DataFrame:
    """Read a stage table with the types it was written with; filters and column choices reach the Parquet scan."""
    try:
        types = spark.read.text(f"{path}/{_SCHEMA}").first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.read.parquet(path)
    return spark.read.schema(StructType.fromJson(json.loads(types.value))).parquet(path)


def scratch_path(spark: SparkSession, label: str, folder: str | None = None) -> str:
    """A new folder name under ``folder``, or else under the shared one that ``spark.checkpoint.dir`` names.

    A machine-local folder is used only where the setting is missing and Spark runs in one process. Whoever owns
    the folder removes what is in it once the results are no longer read.
    """
    root = folder or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/tripmetrics-{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` to a new scratch stage and return the table read back from it.

    This runs a job. Use it on small results that a later plan reads more than once or joins with.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label, folder)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_stage(spark: SparkSession, path: str) -> None:
    """Delete a stage's folder, on any store that Spark writes to. A folder that isn't there is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Stages:
    """The scratch stages of one computation: a folder that holds only what is still to be read.

    ``write`` takes the names of earlier stages that nothing reads after it. They are removed when the new one is
    complete, and not before, so a task that is repeated after an executor was lost finds all of its inputs. Leaving
    the scope, by an error as well, removes the rest, but for stages written as a ``result``: a table returned from
    the scope is read later, and its stages stay until their owner removes them.
    """

    def __init__(self, spark: SparkSession, label: str, folder: str | None = None):
        self.spark = spark
        self.folder = scratch_path(spark, label, folder)
        self._live: dict[str, str] = {}
        self._results: set[str] = set()

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        if kind is not None:
            self._results.clear()
        self.remove(*[name for name in self._live if name not in self._results])
        if not self._live:
            remove_stage(self.spark, self.folder)

    def write(self, df: DataFrame, name: str, done: tuple[str, ...] = (), result: bool = False) -> DataFrame:
        """Write a stage and return the table read back from it. This runs a job; ``done`` is removed after it."""
        if name in self._live:
            raise ValueError(f"stage {name} is still in use")
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        self._live[name] = path
        df.write.mode("errorifexists").parquet(path)
        if result:
            self._results.add(name)
        self.remove(*done)
        return self.spark.read.schema(df.schema).parquet(path)

    def live(self, prefix: str = "") -> list[str]:
        """Names of the stages that are still there."""
        return [name for name in self._live if name.startswith(prefix)]

    def remove(self, *names: str) -> None:
        for name in names:
            remove_stage(self.spark, self._live.pop(name))
