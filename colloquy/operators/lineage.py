"""Cutting lineage through the shared folder of the cluster."""

import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folder of this run by application, made at the first settled table.
_RUNS: dict[str, str] = {}
_SCOPE: ContextVar[str] = ContextVar("scope", default="tables")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Only a local session may go
    without one; on a cluster a machine's own folder would not survive it."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="colloquy-"))
    return context.getCheckpointDir()


def run_folder(spark: SparkSession) -> str:
    """This application's own folder under the shared one.  It is removed when the driver ends;
    ``release`` removes it sooner."""
    app = spark.sparkContext.applicationId
    if app not in _RUNS:
        folder = f"{shared_folder(spark)}/colloquy-{app}-{uuid.uuid4().hex[:8]}"
        files, path = _file_system(spark, folder)
        files.mkdirs(path)
        files.deleteOnExit(path)
        _RUNS[app] = folder
    return _RUNS[app]


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def settle(df: DataFrame, name: str = "table") -> DataFrame:
    """Write the rows once and continue from the written table, so that neither a
    lost executor nor a second use computes them again."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{_SCOPE.get()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scoped(name: str) -> Iterator[None]:
    """Tables settled inside go to a part of the run folder that ``release`` can remove alone."""
    token = _SCOPE.set(name)
    try:
        yield
    finally:
        _SCOPE.reset(token)


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[str]:
    """Tables settled inside go when the block ends, and shuffle files of finished queries with them.  Yields the scope
    around, for tables that stay: ``with scoped(...)``."""
    around = _SCOPE.get()
    scope = f"{around}/passing-{uuid.uuid4().hex}"
    with scoped(scope):
        yield around
    release(spark, scope)
    # Spark's cleaner removes the shuffles that the driver's collector has found unused.
    spark._jvm.System.gc()


def release(spark: SparkSession, scope: str = "tables") -> None:
    """Remove the tables settled so far in a scope.  Call it when every result that builds on
    them has been written."""
    folder = _RUNS.get(spark.sparkContext.applicationId)
    if folder:
        files, path = _file_system(spark, f"{folder}/{scope}")
        files.delete(path, True)
