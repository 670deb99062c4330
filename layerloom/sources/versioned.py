"""Versioned dimensions stored so that a batch touches only what it changes.

Current versions lie in folders by ranges of the business key; closed versions are
added as a folder per load that closed any. As many such folders of one size class as
``fan_in`` become one of the next class, within the load that fills it up, so a
dimension of ``n`` loads has at most ``fan_in`` times ``log(n)`` folders of history and
each closed row is written ``log(n)`` times (to the base ``fan_in``). A batch reads keys and hashes of the current
versions, finds what changed, and writes anew the ranges that hold a changed or new
key, with what it closed beside them. Other ranges and all earlier history are
neither read in full nor, but for that merging, written; a batch that changes nothing
writes nothing.

``state`` says which folders make up the dimension. It is plain data for a commit's
facts: a reader of an older state is not disturbed, as no folder is ever rewritten.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.functions.hashing import record_hash
from layerloom.operators.keys import dense_key
from layerloom.operators.scd2 import batch_time
from layerloom.operators.staging import write_through

#: Rows that a range of current versions is meant to have; one of twice as many is split.
ROWS_PER_RANGE = 5_000_000
#: Bounds looked through at once when a key's range is found.
STRIDE = 32
#: Folders of closed versions of one size class that are merged into one.
FAN_IN = 16


def fold_levels(levels: Sequence[int], fan_in: int) -> list[int]:
    """Size classes, largest first, after one more folder of the least class: full runs count one class up."""
    out = [*levels, 0]
    while len(out) >= fan_in and out[-fan_in] == out[-1]:
        out[-fan_in:] = [out[-1] + 1]
    return out


@dataclass(frozen=True)
class VersionedDimension:
    """Where a dimension is stored, and its keys. ``incoming`` snapshots hold one row per key and no NULL keys."""

    spark: SparkSession
    path: str
    keys: Sequence[str]
    tracked: Sequence[str]
    sk: str
    rows_per_range: int = ROWS_PER_RANGE
    null_safe_hash: bool = False
    fan_in: int = FAN_IN

    def __post_init__(self):
        if self.fan_in < 2:
            raise ValueError("fan_in is at least 2")

    # --- reading -----------------------------------------------------------------

    def _read(self, state: dict, paths: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def current(self, state: dict) -> DataFrame:
        return self._read(state, [r["path"] for r in state["ranges"]])

    def closed(self, state: dict) -> DataFrame:
        return self._read(state, state["closed"])

    def read(self, state: dict) -> DataFrame:
        """Every version."""
        return self._read(state, self.paths(state))

    @staticmethod
    def paths(state: dict) -> list[str]:
        return [*(r["path"] for r in state["ranges"]), *state["closed"]]

    # --- ranges ------------------------------------------------------------------

    def _range(self, bounds: list[str], schema: T.StructType) -> Column:
        """How many of the ascending bounds a key reaches: first whole strides of them, then those of its stride."""
        kinds = ", ".join(f"`{k}`: {schema[k].dataType.simpleString()}" for k in self.keys)
        key = F.struct(*self.keys)

        def literal(values: list[str], kind: str) -> Column:
            return F.from_json(F.lit(f"[{', '.join(values)}]"), kind)

        one = f"array<struct<{kinds}>>"
        if not bounds:
            return F.lit(0)
        strides = [bounds[i : i + STRIDE] for i in range(0, len(bounds), STRIDE)]
        if len(strides) == 1:
            return F.size(F.filter(literal(bounds, one), lambda b: b <= key))
        whole = F.size(F.filter(literal([s[0] for s in strides[1:]], one), lambda b: b <= key))
        nested = F.from_json(F.lit(f"[{', '.join('[' + ', '.join(s) + ']' for s in strides)}]"), f"array<{one}>")
        return whole * STRIDE + F.size(F.filter(F.get(nested, whole), lambda b: b <= key))

    def _bounds(self, rows: DataFrame, pieces: int) -> list[str]:
        """The least key of each of about ``pieces`` equal parts but the first, ascending, as JSON."""
        if pieces < 2:
            return []
        key = F.struct(*self.keys)
        parts = rows.select(*self.keys).repartitionByRange(pieces, *self.keys)
        least = parts.groupBy(F.spark_partition_id().alias("part")).agg(F.min(key).alias("low"))
        found = least.orderBy("low").select(F.to_json("low")).collect()  # a row per range
        return [r[0] for r in found][1:]

    def _store(self, rows: DataFrame, bounds: list[str], folder: str) -> list[dict]:
        """Write current versions by range; the ranges that got any."""
        place = self._range(bounds, rows.schema)
        ranged = rows.withColumn("_range", place).hint("rebalance", "_range")
        ranged.sortWithinPartitions(*self.keys).write.mode("overwrite").partitionBy("_range").parquet(folder)
        back = self.spark.read.schema(T.StructType([T.StructField("_range", T.IntegerType())])).parquet(folder)
        counts = {r["_range"]: r["count"] for r in back.groupBy("_range").count().collect()}
        return [
            {"low": bounds[i - 1] if i else None, "path": f"{folder}/_range={i}", "rows": counts[i]} for i in sorted(counts)
        ]

    def _split(self, ranges: list[dict], schema: str, folder: str) -> list[dict]:
        """Ranges that have grown to twice their size, in several; the others as they are."""
        out = []
        for n, held in enumerate(ranges):
            if held["rows"] < 2 * self.rows_per_range:
                out.append(held)
                continue
            rows = self._read({"schema": schema}, [held["path"]])
            bounds = self._bounds(rows, -(-held["rows"] // self.rows_per_range))
            parts = self._store(rows, bounds, f"{folder}-split-{n}")
            out += [{**p, "low": p["low"] or held["low"]} for p in parts]
        return out

    # --- loading -----------------------------------------------------------------

    def _new_versions(self, rows: DataFrame, ts: datetime | str, base: int) -> DataFrame:
        keyed = dense_key(rows, self.keys, self.sk, base=F.lit(base).cast("bigint"))
        return keyed.withColumns(
            {
                "valid_from": batch_time(ts),
                "valid_to": F.lit(None).cast("timestamp_ntz"),
                "is_current": F.lit(True),
            }
        )

    def _seed(self, hashed: DataFrame, load: str, ts: datetime | str) -> dict:
        rows = write_through(self._new_versions(hashed, ts, 0), "dimension-seed")
        total = rows.count()
        bounds = self._bounds(rows, -(-total // self.rows_per_range))
        ranges = self._store(rows, bounds, f"{self.path}/current/load={load}")
        schema = rows.schema.json()
        return {"ranges": ranges, "closed": [], "levels": [], "max_key": total, "schema": schema, "load": load}

    def _add_closed(self, state: dict, gone: DataFrame, load: str) -> dict:
        """The history with ``gone`` as its newest folder, which takes in the folders that it fills a run up of."""
        closed = state["closed"]
        # a state of before folders were merged has no classes
        levels = fold_levels(state.get("levels", [0] * len(closed)), self.fan_in)
        kept = len(levels) - 1
        if kept < len(closed):
            gone = self._read(state, closed[kept:]).unionByName(gone).hint("rebalance")
        path = f"{self.path}/closed/load={load}"
        gone.write.mode("overwrite").parquet(path)
        return {"closed": [*closed[:kept], path], "levels": levels}

    def apply(
        self, state: dict | None, incoming: DataFrame, load: str, ts: datetime | str, *, close_missing: bool = False
    ) -> dict:
        """The state after a snapshot; ``state`` itself where nothing changed. ``load`` names new folders."""
        hashed = incoming.withColumn("record_hash", record_hash(self.tracked, null_safe=self.null_safe_hash))
        if state is None:
            return self._seed(hashed, load, ts)
        keys = list(self.keys)
        known = self.current(state).select(*keys, F.col("record_hash").alias("_known"))
        arriving = hashed.select(*keys, F.struct(*hashed.columns).alias("_new"))
        both = arriving.join(known, keys, "full_outer" if close_missing else "left")
        differs = F.col("_known").isNull() | F.col("_new").isNull() | (F.col("_known") != F.col("_new.record_hash"))
        changes = write_through(both.where(differs), "dimension-changes")

        bounds = [r["low"] for r in state["ranges"] if r["low"] is not None]
        place = self._range(bounds, changes.schema)
        touched = {r[0] for r in changes.select(place).distinct().collect()}  # at most as many as there are ranges
        if not touched:
            return state
        # the first range has no bound; it is absent only where all its keys have gone
        offset = 1 if state["ranges"] and state["ranges"][0]["low"] is not None else 0
        held = {i + offset: r for i, r in enumerate(state["ranges"])}
        before = self._read(state, [held[i]["path"] for i in sorted(touched) if i in held])

        ended = changes.where(F.col("_known").isNotNull()).select(*keys)
        added = self._new_versions(changes.where(F.col("_new").isNotNull()).select("_new.*"), ts, state["max_key"])
        columns = before.columns
        rows = before.join(ended, keys, "left_anti").select(*columns).unionByName(added.select(*columns))
        folder = f"{self.path}/current/load={load}"
        stored = self._split(self._store(rows, bounds, folder), state["schema"], folder)
        ranges = [r for i, r in held.items() if i not in touched] + stored
        history = {}
        if not ended.isEmpty():
            gone = before.join(ended, keys, "left_semi").select(*columns)
            gone = gone.withColumns({"valid_to": batch_time(ts), "is_current": F.lit(False)})
            history = self._add_closed(state, gone, load)
        new = changes.where(F.col("_new").isNotNull()).count()
        return {
            **state,
            **history,
            "ranges": self._ordered(ranges, before.schema),
            "max_key": state["max_key"] + new,
            "load": load,
        }

    def _ordered(self, ranges: list[dict], schema: T.StructType) -> list[dict]:
        """Ranges by their bounds; text alone would put 10 before 9."""
        kinds = ", ".join(f"`{k}`: {schema[k].dataType.simpleString()}" for k in self.keys)
        lows = [(i, r["low"]) for i, r in enumerate(ranges)]
        frame = self.spark.createDataFrame(lows, "i int, low string")
        order = frame.orderBy(F.from_json("low", f"struct<{kinds}>").asc_nulls_first()).collect()
        return [ranges[r["i"]] for r in order]
