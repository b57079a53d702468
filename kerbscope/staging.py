"""Tables that cut lineage: written to the shared folder the cluster names.

An aggregate that is read several times (population bounds, ranking, joins) is
written once as parquet and read back.  The files live in the folder named by
``spark.checkpoint.dir``, so a lost executor costs a re-read and not a second
pass over the events; parquet also gives exact sizes, which lets Spark choose
broadcast joins by a measured size, and row counts from the footers.

Tables are deleted by whom they belong to: ``scratch`` deletes what was staged
within it, an operator's results excepted, which belong to the scratch around.
So ``with scratch(spark): query(spark, folder).write...`` leaves nothing behind;
what belongs to no scratch stays until ``remove_staged`` at the end of a job.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
#: Paths that belong to the open scratches, the innermost last.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("open_scratches", default=())


def shared_folder(spark: SparkSession) -> str:
    """Folder named by the session; a private one only for local test sessions."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="kerbscope-")
    return _local_roots[app]


def run_folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/kerbscope/{app}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def remove_staged(spark: SparkSession) -> None:
    """Delete what this application staged; for the end of a batch job."""
    _delete(spark, run_folder(spark))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged within, which nothing outside may read, are deleted at the end; results are not."""
    own: list[str] = []
    before = _open.set((*_open.get(), own))
    try:
        yield
    finally:
        _open.reset(before)
        for path in own:
            _delete(spark, path)


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), result: bool = False) -> DataFrame:
    """Write ``df`` once and return a reader over the written table, whose partition columns come last.

    It belongs to the innermost open scratch, a ``result`` to the one around that.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    owners = _open.get()[:-1] if result else _open.get()
    if owners:
        owners[-1].append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._staged_path = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a staged table that is read no more; any other table is left alone."""
    path = getattr(table, "_staged_path", None)
    if path:
        _delete(table.sparkSession, path)
