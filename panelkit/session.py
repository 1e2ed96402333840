"""Shared storage for intermediate tables.

Lineage is cut by writing a table into the folder that the cluster names in
``spark.checkpoint.dir``: such a table outlives any executor, keeps column pruning and
filter push-down for its readers, and is computed once for all of them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach; a temporary one only in local mode with none set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster is a cluster
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="panelkit-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_scopes: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    """Unused path for a table of this application under the shared folder."""
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/panelkit/{app}/{name}-{uuid.uuid4().hex[:12]}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that are stored inside the block at its end, but for those that ``keep`` has
    handed on. Results that are to be used later must be stored and kept, or collected, inside."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def keep(df: DataFrame) -> DataFrame:
    """Hand a stored table on to the block around the present one, which removes it (if there is one)."""
    names = {file.rstrip("/") for file in df.inputFiles()}
    for path in list(_scopes[-1]) if _scopes else []:
        folder = path.split("://", 1)[-1]
        if any(folder.removeprefix("file:") in name for name in names):
            _scopes[-1].remove(path)
            if len(_scopes) > 1:
                _scopes[-2].append(path)
    return df


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored table; one that is not there is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and return a scan of it.

    With ``partition_by`` each value of these columns has a folder of its own, which readers can
    leave out. Rows are dealt by these columns first, so that a folder gets few files; Spark
    divides large values among tasks and merges small ones.
    """
    path = new_path(df.sparkSession, name)
    if partition_by:
        dealt = df.hint("rebalance", *partition_by)
        dealt.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``materialise``, and the number of rows, counted while they are written."""
    rows = Observation()
    stored = materialise(df.observe(rows, F.count(F.lit(1)).alias("rows")), name)
    return stored, rows.get["rows"]
