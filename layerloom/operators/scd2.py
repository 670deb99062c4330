"""Versioned dimensions (slowly changing, type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.hashing import record_hash
from layerloom.operators.keys import dense_key, max_key
from layerloom.operators.staging import write_through

VERSION_COLUMNS = ("valid_from", "valid_to", "is_current")


def batch_time(batch_ts: datetime | str) -> Column:
    """The batch instant as a zone-less literal: one value for the whole run."""
    return F.lit(str(batch_ts)).cast("timestamp_ntz")


def seed_dimension(
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    sk: str,
    batch_ts: datetime | str,
    *,
    null_safe_hash: bool = False,
) -> DataFrame:
    """First load: every row is a current version, keyed 1..n over the business keys."""
    hashed = incoming.withColumn("record_hash", record_hash(tracked, null_safe=null_safe_hash))
    return _as_new_versions(hashed, keys, sk, batch_ts, base=None)


def _as_new_versions(hashed, keys, sk, batch_ts, *, base):
    keyed = dense_key(hashed, keys, sk, base=base)
    return keyed.withColumns(
        {
            "valid_from": batch_time(batch_ts),
            "valid_to": F.lit(None).cast("timestamp_ntz"),
            "is_current": F.lit(True),
        }
    )


def compare_snapshot(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    sk: str,
    batch_ts: datetime | str,
    *,
    close_missing: bool = False,
    null_safe_hash: bool = False,
) -> DataFrame:
    """Current versions against a snapshot: rows of the next dimension with their ``change``.

    ``unchanged``, ``carried`` (key absent from the snapshot), ``expired`` and
    ``closed`` rows keep their key. ``new`` rows, of new keys and of changed
    ones alike, have a NULL key still to be assigned. Each side is shuffled
    once, and history takes no part.
    """
    hashed = incoming.withColumn("record_hash", record_hash(tracked, null_safe=null_safe_hash))
    columns = hashed.columns
    values = [*columns, sk, *VERSION_COLUMNS]
    stored = existing.where("is_current").select(F.struct(*values).alias("old"), *keys)
    arriving = hashed.select(F.struct(*columns).alias("new"), *keys)
    both = stored.join(arriving, list(keys), "full_outer").select("old", "new")

    now = batch_time(batch_ts)

    def version(side: str, change: str, **override: Column) -> Column:
        fields = {c: F.col(f"{side}.{c}") for c in columns}
        if side == "old":
            fields |= {c: F.col(f"old.{c}") for c in (sk, *VERSION_COLUMNS)}
        fields |= override
        return F.struct(
            F.lit(change).alias("change"),
            *[fields[c].cast(existing.schema[c].dataType).alias(c) for c in values],
        )

    kept = version("old", "unchanged")
    ended = {"valid_to": now, "is_current": F.lit(False)}
    expired = version("old", "expired", **ended)
    absent = version("old", "closed", **ended) if close_missing else version("old", "carried")
    added = version(
        "new",
        "new",
        **{sk: F.lit(None), "valid_from": now, "valid_to": F.lit(None), "is_current": F.lit(True)},
    )
    emitted = (
        F.when(F.col("old").isNull(), F.array(added))
        .when(F.col("new").isNull(), F.array(absent))
        .when(F.col("old.record_hash") == F.col("new.record_hash"), F.array(kept))
        .otherwise(F.array(expired, added))
    )
    return both.select(F.inline(emitted))


def scd2_merge(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    sk: str,
    batch_ts: datetime | str,
    *,
    close_missing: bool = False,
    null_safe_hash: bool = False,
) -> DataFrame:
    """The whole next dimension: history, kept, expired and newly keyed versions.

    ``incoming`` holds one row per key and no NULL keys. Merging the same snapshot again changes nothing; a change in
    an untracked column alone does not make a version.
    """
    compared = compare_snapshot(
        existing,
        incoming,
        keys,
        tracked,
        sk,
        batch_ts,
        close_missing=close_missing,
        null_safe_hash=null_safe_hash,
    )
    # Numbering reads the new rows several times; join once and read that.
    compared = write_through(compared, "scd2").drop("change")
    kept = compared.where(F.col(sk).isNotNull())
    new = compared.where(F.col(sk).isNull()).select(
        *[c for c in compared.columns if c not in (sk, *VERSION_COLUMNS)]
    )
    added = _as_new_versions(new, keys, sk, batch_ts, base=max_key(existing, sk))
    history = existing.where("NOT is_current").select(*kept.columns)
    return history.unionByName(kept).unionByName(added)


def current_versions(dimension: DataFrame) -> DataFrame:
    return dimension.where("is_current")
