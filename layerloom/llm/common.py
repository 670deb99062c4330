"""Helpers the operators share: written intermediates and content identities."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a content hash, taken from the front of its MD5.
HASH_BITS = 60


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local run without one makes its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        named = tempfile.mkdtemp(prefix="layerloom-llm-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Evaluate ``df`` once into the checkpoint folder; Spark removes it with the last reference."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


_scope: ContextVar[list[str] | None] = ContextVar("stored", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is ``stored`` inside is deleted at the end; results that outlive it must have been evaluated."""
    held: list[str] = []
    token = _scope.set(held)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in held:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Evaluate ``df`` once into a compressed table in the checkpoint folder, for the ``scratch`` it is in."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    held = _scope.get()
    if held is not None:
        held.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def content_md5(key: str, text: str) -> Column:
    """MD5 of a document's key and whole text; rows that agree in both share it."""
    return F.md5(
        F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.md5(text_or_empty(text)))
    )


def leading_bits(md5: Column, digits: int) -> Column:
    """The first hex digits as a non-negative long (15 at most)."""
    return F.conv(F.substring(md5, 1, digits), 16, 10).cast("long")


#: The same identity in DuckDB.
SQL_CONTENT_MD5 = "md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')))"
