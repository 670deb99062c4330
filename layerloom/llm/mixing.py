"""Sources mixed to target weights by Poisson replication.

A source of ``b`` bytes with target share ``p`` of the total ``t`` has the mean
repetition rate ``p * t / b``. Each document draws its number of copies from a
Poisson distribution with that mean by inverting the distribution function at a
number hashed from seed, key and text, so a rerun draws the same copies. Rates
above 16 are the sum of as many smaller independent draws as it takes, which
keeps ``exp(-rate)`` away from zero at any rate.

NULL is a source of its own. A document counts one byte more than its text, so a
source of empty texts has a rate too. Rows equal in key and text draw alike. An
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import content_md5, cut, leading_bits, text_or_empty

PART_MEAN = 16
#: Terms of a distribution function; the rest has a probability under 1e-28 at mean 16.
TERMS = 80
UNIFORM_DIGITS = 13
#: A row of rates is about 700 bytes, so this many are 7 MB.
BROADCAST_SOURCES = 10_000


def _distribution(mean: Column) -> Column:
    """Cumulative Poisson probabilities of 0 to ``TERMS``."""
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))

    def extended(acc: Column, n: Column) -> Column:
        p = acc["p"] * mean / n
        return F.struct(p.alias("p"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + p)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, extended, lambda acc: acc["cdf"])


def repetition_rates(
    docs: DataFrame, *, source: str = "source", text: str = "text", alpha: float = 0.7, weights: DataFrame | None = None
) -> DataFrame:
    """``source``, ``bytes`` and ``rate``: by ``weights`` (source, weight), or by ``bytes ** alpha``.

    A source that ``weights`` leaves out has weight 0.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.octet_length(text_or_empty(text)) + F.lit(1).cast("long")).alias("bytes")
    )
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("bytes").cast("double"), F.lit(alpha)))
    else:
        wanted = weights.groupBy(F.col("source").alias("wanted")).agg(F.sum("weight").alias("weight"))
        sizes = sizes.join(wanted, F.col("source").eqNullSafe(F.col("wanted")), "left").select(
            "source", "bytes", F.coalesce(F.col("weight").cast("double"), F.lit(0.0)).alias("weight")
        )
    sizes = cut(sizes)
    totals = sizes.agg(F.sum("bytes").cast("double").alias("bytes"), F.sum("weight").alias("weight")).first()
    if not totals["weight"]:
        return sizes.select("source", "bytes", F.lit(0.0).alias("rate"))
    share = F.col("weight") / totals["weight"]
    return sizes.select("source", "bytes", (share * totals["bytes"] / F.col("bytes")).alias("rate"))


def poisson_mix(
    docs: DataFrame,
    rates: DataFrame,
    *,
    seed: int = 17,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``row`` (the whole input row) per copy, ``copy`` from 1, ``shuffle_key``; sorted by that key."""
    drawn = rates.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_MEAN)).cast("int")).select(
        F.col("source").alias("rate_source"), "parts", _distribution(F.col("rate") / F.col("parts")).alias("cdf")
    )
    drawn = cut(drawn)
    side = F.broadcast(drawn) if drawn.count() <= BROADCAST_SOURCES else drawn
    rows = docs.select(
        F.struct("*").alias("row"), F.col(source).alias("row_source"), content_md5(key, text).alias("id")
    )

    def uniform(part: Column) -> Column:
        digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("id"), F.lit(":"), part.cast("string")))
        return leading_bits(digest, UNIFORM_DIGITS) / F.lit(float(16**UNIFORM_DIGITS))

    def draw(total: Column, part: Column) -> Column:
        at = uniform(part)
        return total + F.size(F.filter("cdf", lambda c: c <= at))

    copies = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), draw)
    spread = F.md5(F.concat(F.lit(f"{seed}:order:"), F.col("id"), F.lit(":"), F.col("copy").cast("string")))
    return (
        rows.join(side, F.col("row_source").eqNullSafe(F.col("rate_source")))
        .withColumn("copies", copies)
        .where("copies > 0")
        .select("row", "id", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select("row", "copy", leading_bits(spread, 15).alias("shuffle_key"))
        .orderBy("shuffle_key", "copy")
    )


def mix_sources(docs: DataFrame, *, alpha: float = 0.7, weights: DataFrame | None = None, seed: int = 17) -> DataFrame:
    """The columns of ``docs``, each document as often as drawn, in an order that mixes all sources."""
    rates = repetition_rates(docs, alpha=alpha, weights=weights)
    mixed = poisson_mix(docs, rates, seed=seed)
    return mixed.select(*[F.col("row")[c].alias(c) for c in docs.columns])
