"""Written intermediate tables, for plans that must not be evaluated twice."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The shared folder the session names; a local run without one gets its own."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="layerloom-"))
    return context.getCheckpointDir()


_loose: list[str] = []
_scope: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def staged_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the staging root, deleted like what ``write_through`` writes."""
    path = f"{staging_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    held = _scope.get()
    (_loose if held is None else held).append(path)
    return path


def write_through(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the scan of what was written.

    The result no longer depends on the upstream plan: lost executors cost a
    re-read, and later passes read only the columns they need. The files stay
    until their ``staging_scope`` ends or, outside one, until ``clear_staged``,
    as the caller's plan still reads them.
    """
    spark = df.sparkSession
    path = staged_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end, also of a run that fails; threads have scopes of their own."""
    held: list[str] = []
    token = _scope.set(held)
    try:
        yield
    finally:
        _scope.reset(token)
        _delete(spark, held)


def clear_staged(spark: SparkSession) -> None:
    """Delete what was staged outside any scope, once every result built on it is stored."""
    _delete(spark, _loose)
