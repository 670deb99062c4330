"""Tables stored in buckets of a key, so that joins and groupings on it need no shuffle.

Buckets belong to a table of the session's catalog; its files lie where the caller
says. Two tables in the same number of buckets of the same key, sorted by it, meet
bucket by bucket. The number is a storage decision for all tables of a key: about the
larger table's size over what one task should read. A key with very many rows makes
its bucket large, so bucket by keys that are unique or nearly so on one side and
leave heavy keys to ``operators.skew``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame


def store_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` to ``path`` in ``buckets`` of ``keys``, sorted by them, and return the table."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    # one file a bucket: Spark only trusts the order of buckets that are single files
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).saveAsTable(name)
    return spark.table(name)
