"""Change-detection hashes and an engine-independent bucket number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and digest size of the record hash.
HASH_SEPARATOR = "||"
HASH_BITS = 256


def record_hash(columns: Sequence[str], *, null_safe: bool = False) -> Column:
    """SHA-256 over the columns' text, in the order given.

    By default NULL and the empty string hash alike and a separator inside a
    value can make two rows collide, as in the data this has to agree with.
    ``null_safe=True`` prefixes each value with its length, so neither happens.
    Cast floating point columns to decimal first: their text is engine-specific.
    """
    texts = [F.col(c).cast("string") for c in columns]
    if null_safe:
        encoded = F.concat(
            *[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
        )
    else:
        encoded = F.concat_ws(HASH_SEPARATOR, *[F.coalesce(t, F.lit("")) for t in texts])
    return F.sha2(encoded, HASH_BITS)


def stable_bucket(value: Column, buckets: Column) -> Column:
    """``0 <= bucket < buckets`` from the first 60 bits of SHA-256; NULL for no buckets.

    Spread evenly and equal in every engine that has SHA-256, unlike each
    engine's own 64-bit hash.
    """
    digest = F.substring(F.sha2(value.cast("string"), 256), 1, 15)
    number = F.conv(digest, 16, 10).cast("bigint")
    return F.pmod(number, F.nullif(buckets, F.lit(0).cast("bigint")))
