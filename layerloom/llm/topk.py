"""Exact top-k inner products by distributed histogram selection.

Components become integers ``floor(256 * x)``, so scores are integers, and exact: as
doubles while no score of the block can reach 2**53, as 64-bit integers up to 2**62,
and as unbounded integers beyond, which is slow. A score of ``MOST``, the largest
long, or more counts as ``MOST``, one of its negative or less as that. For a block of queries every vector is scored in every pass:
histograms of the scores, summed up over all tasks, show the bin that holds each
query's k-th highest score; the next pass counts inside that bin, until bins are
one score wide. A last pass returns the scores above the k-th, of which there are
fewer than k, and from each task the smallest ids among those equal to it.

Queries are taken in blocks of about ``QUERY_BLOCK``; a block and its thresholds
are all that is broadcast or sent to the driver at once. No pair of vectors is
ever stored or shuffled, only counts per query and bin.

Vectors that are NULL or hold NULL or non-finite components (256 times as much
included) take no part, nor do rows with a NULL id. Only vectors of equal length are compared. A candidate with
the query's id is the query's own row. Rows equal in id and components are one
query, but each is a candidate. With fewer than k candidates all are returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerloom.llm.common import cut

SCALE = 256
MOST = (1 << 63) - 1
BINS = 512
QUERY_BLOCK = 1024
#: Queries scored against a batch at once; bounds memory only.
SCORED = 128


def quantised(vectors: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column that take part, by length: their indices and integer components."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.array(pc.fill_null(pc.list_value_length(vectors), -1))
    flat = vectors.flatten()  # without what NULL rows hide
    values = np.asarray(flat.cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
    with np.errstate(over="ignore"):
        values = np.floor(SCALE * values) + 0.0  # no negative zero
    sized = np.maximum(lengths, 0)
    owner = np.repeat(np.arange(len(lengths)), sized)
    bad = lengths < 0
    bad[owner[~np.isfinite(values)]] = True
    starts = np.cumsum(sized) - sized
    out = []
    for length in np.unique(lengths[~bad]):
        rows = np.flatnonzero(~bad & (lengths == length))
        out.append((rows, values[starts[rows][:, None] + np.arange(length)]))
    return out


def _quantise(batches):
    for batch in batches:
        ids, vectors = [], []
        for rows, whole in quantised(batch.column("vector")):
            ids.append(batch.column("id").take(pa.array(rows)))
            vectors += list(whole)
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays(ids), pa.array(vectors, pa.list_(pa.float64()))], names=["id", "vector"]
            )


def _whole(values: np.ndarray, kind: type) -> np.ndarray:
    """Whole doubles as numbers of a kind that products are exact in."""
    if kind is not object:
        return values.astype(kind)
    return np.array([int(v) for v in values.ravel()], object).reshape(values.shape)


class Queries:
    """A block of queries, with the range of scores that holds each one's k-th highest."""

    def __init__(self, rows: list, largest: float, k: int):
        bound = [min(MOST, sum(int(abs(v)) for v in r["vector"]) * int(largest)) for r in rows]
        most = max(bound, default=0)
        self.kind = np.float64 if most < 1 << 53 else np.int64 if most < 1 << 62 else object
        self.ids = np.array([r["id"] for r in rows], np.int64)
        lengths = np.array([len(r["vector"]) for r in rows])
        self.by_length = {
            int(n): (at := np.flatnonzero(lengths == n), _whole(np.array([rows[i]["vector"] for i in at], np.float64), self.kind))
            for n in np.unique(lengths)
        }
        bounds = np.array(bound, object if self.kind is object else np.int64)
        self.low, self.high = -bounds, bounds + 1  # scores are in [low, high)
        self.rest = np.full(len(rows), k)  # how many of the highest are at or below the range's top
        self.all = np.zeros(len(rows), bool)  # fewer than k candidates

    @property
    def width(self) -> np.ndarray:
        return -(-(self.high - self.low) // BINS)

    @property
    def open(self) -> np.ndarray:
        return ~self.all & np.array(self.high - self.low > 1, bool)

    def scored(self, ids: np.ndarray, vectors: pa.Array, wanted: np.ndarray):
        """Blocks of scores: query indices, candidate rows, scores, and which of these aren't a query's own row."""
        for rows, candidates in quantised(vectors):
            which, matrix = self.by_length.get(candidates.shape[1], (np.zeros(0, np.int64), None))
            use = np.flatnonzero(wanted[which])
            candidates = _whole(candidates, self.kind) if len(use) else candidates
            for at in range(0, len(use), SCORED):
                part = use[at : at + SCORED]
                others = self.ids[which[part]][:, None] != ids[rows][None, :]
                scores = matrix[part] @ candidates.T
                if self.kind is object:
                    scores = np.maximum(np.minimum(scores, MOST), -MOST)
                yield which[part], rows, scores, others


def _histogram(queries):
    def count(batches):
        block = queries.value
        wanted, width = block.open, block.width
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for which, _, scores, others in block.scored(batch.column("id").to_numpy(), batch.column("vector"), wanted):
                low, high, wide = (a[which][:, None] for a in (block.low, block.high, width))
                inside = others & np.array((scores >= low) & (scores < high), bool)
                bins = ((scores - low) // wide)[inside].astype(np.int64)
                flat = np.nonzero(inside)[0] * BINS + bins
                counts = np.bincount(flat, minlength=len(which) * BINS).reshape(len(which), BINS)
                for q, row in zip(which.tolist(), counts, strict=True):
                    total[q] = total[q] + row if q in total else row
        for q, row in total.items():
            filled = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(filled), q, np.int32)), pa.array(filled.astype(np.int32)), pa.array(row[filled])],
                names=["query", "bin", "n"],
            )

    return count


def _select(queries):
    def pick(batches):
        block = queries.value
        wanted = np.ones(len(block.ids), bool)
        for batch in batches:
            ids = batch.column("id").to_numpy()
            out = [np.zeros(0, np.int64)] * 3
            for which, rows, scores, others in block.scored(ids, batch.column("vector"), wanted):
                every, floor = block.all[which][:, None], block.low[which][:, None]
                q, c = np.nonzero(others & (every | np.array(scores > floor, bool)))
                tie_q, tie_c = np.nonzero(others & ~every & np.array(scores == floor, bool))
                # of equal scores only as many of the smallest ids as there is room for
                order = np.lexsort((ids[rows[tie_c]], tie_q))
                tie_q, tie_c = tie_q[order], tie_c[order]
                nth = np.arange(len(tie_q)) - np.searchsorted(tie_q, tie_q)
                few = nth < block.rest[which[tie_q]]
                q, c = np.append(q, tie_q[few]), np.append(c, tie_c[few])
                found = (block.ids[which[q]], ids[rows[c]], scores[q, c].astype(np.int64))
                out = [np.append(a, b) for a, b in zip(out, found, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in out], names=["query_id", "vec_id", "score"])

    return pick


def _refine(rows: DataFrame, queries: Queries) -> None:
    """Narrow each open query's range to the bin of its k-th highest score."""
    context = rows.sparkSession.sparkContext
    counts = (
        rows.mapInArrow(_histogram(context.broadcast(queries)), "query int, bin int, n bigint")
        .groupBy("query", "bin")
        .agg(F.sum("n").alias("n"))
    )
    down = Window.partitionBy("query").orderBy(F.desc("bin"))
    reached = F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rest = [(i, int(r)) for i, r in enumerate(queries.rest)]
    needed = rows.sparkSession.createDataFrame(rest, "query int, rest bigint")
    found = (
        counts.withColumn("reached", reached)
        .join(F.broadcast(needed), "query")  # one row per query of the block
        .where("reached >= rest and reached - n < rest")
        .select("query", "bin", (F.col("reached") - F.col("n")).alias("above"))
        .collect()
    )
    closed = queries.open
    width = queries.width
    for row in found:
        q = row["query"]
        closed[q] = False
        low = queries.low[q] + row["bin"] * width[q]
        queries.low[q], queries.high[q] = low, min(low + width[q], queries.high[q])
        queries.rest[q] -= row["above"]
    queries.all |= closed  # no bin reaches k: there are fewer candidates


def top_k(
    vectors: DataFrame, is_query: Column, *, k: int, id: str = "vec_id", vector: str = "embedding", block: int = QUERY_BLOCK
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of each query's ``k`` best candidates."""
    rows = vectors.select(
        F.col(id).cast("bigint").alias("id"), F.col(vector).alias("vector"), is_query.alias("asks")
    ).where("id is not null and vector is not null")
    kind = "id bigint, vector array<double>"
    queries = cut(rows.where("asks").select("id", "vector").mapInArrow(_quantise, kind).distinct())
    rows = rows.select("id", "vector")
    largest = rows.mapInArrow(_largest, "most double").agg(F.max("most")).first()[0] or 0
    blocks = -(-queries.count() // block)
    out = None
    for n in range(blocks):
        # by id and components: also vectors that share an id go to all blocks
        some = queries.where(F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)) == n).orderBy("id").collect()
        asked = Queries(some, largest, k)
        while asked.open.any():
            _refine(rows, asked)
        shared = vectors.sparkSession.sparkContext.broadcast(asked)
        found = rows.mapInArrow(_select(shared), "query_id bigint, vec_id bigint, score bigint")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _largest(batches):
    most = 0.0
    for batch in batches:
        for _, whole in quantised(batch.column("vector")):
            most = max(most, float(np.abs(whole).max(initial=0)))
    yield pa.RecordBatch.from_arrays([pa.array([most], pa.float64())], names=["most"])
