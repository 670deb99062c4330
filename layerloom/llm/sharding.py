"""Shards under a byte limit by extendible hashing.

Documents hash to 60 bits. The directory starts with one bucket; a bucket over
the limit splits on its next bit, and only such buckets split. Twelve levels are
settled per pass from one histogram of at most 4,096 cells per open bucket, so
the number of passes is the depth of the directory divided by twelve.

A bucket with one row is never split. Rows equal in key and whole text cannot be
parted by any bit: if they still exceed the limit at the last bit, each task deals its
own out to overflow pages, as extendible hashing does for equal keys. NULL keys and texts hash as empty; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.common import HASH_BITS, content_md5, cut, leading_bits, text_or_empty

STEP = 12
DEFAULT_MAX_BYTES = 16 * 1024 * 1024


def _cell(width: int) -> Column:
    return F.shiftright("h", HASH_BITS - width)


def _directory(rows: DataFrame, lower: int, width: int, max_bytes: int) -> DataFrame:
    """Cells of ``width`` bits with the depth of their bucket; NULL while it must split further."""
    cells = cut(rows.groupBy(_cell(width).alias("cell")).agg(F.sum("size").alias("size"), F.count("*").alias("n")))
    levels = cells.select(
        "cell", "size", "n", F.explode(F.sequence(F.lit(lower), F.lit(width))).alias("depth")
    ).withColumn("prefix", F.expr(f"shiftright(cell, {width} - depth)"))
    fitting = (
        levels.groupBy("depth", "prefix")
        .agg(F.sum("size").alias("size"), F.sum("n").alias("n"))
        .where((F.col("size") <= max_bytes) | (F.col("n") <= 1))
        .select("depth", "prefix")
    )
    leaves = levels.join(fitting, ["depth", "prefix"]).groupBy("cell").agg(F.min("depth").alias("leaf"))
    return cut(cells.select("cell").join(leaves, "cell", "left"))


def extendible_shards(
    docs: DataFrame, *, max_bytes: int = DEFAULT_MAX_BYTES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``row`` (the whole input row), ``size``, ``shard_depth`` and ``shard`` (its prefix bits as text)."""
    rows = docs.select(
        F.struct("*").alias("row"),
        F.octet_length(text_or_empty(text)).cast("long").alias("size"),
        leading_bits(content_md5(key, text), HASH_BITS // 4).alias("h"),
    )
    placed, hashes, lower = rows.withColumn("leaf", F.lit(None).cast("int")), rows.select("h", "size"), 0
    while lower < HASH_BITS:
        width = min(lower + STEP, HASH_BITS)
        directory = _directory(hashes, lower, width, max_bytes).select(
            F.col("cell").alias(f"cell{width}"), F.col("leaf").alias(f"leaf{width}")
        )
        # the first directory has 2^12 rows at most; later ones grow with the table and Spark chooses
        side = F.broadcast(directory) if lower == 0 else directory
        placed = placed.join(side, _cell(width) == F.col(f"cell{width}"), "left").select(
            "row", "size", "h", F.coalesce("leaf", f"leaf{width}").alias("leaf")
        )
        still = directory.where(F.col(f"leaf{width}").isNull()).select(f"cell{width}")
        if still.isEmpty():
            break
        hashes = hashes.join(still, _cell(width) == F.col(f"cell{width}"), "left_semi")
        lower = width
    bits = F.expr(f"right(lpad(bin(shiftright(h, {HASH_BITS} - leaf)), {HASH_BITS}, '0'), leaf)")
    fits = placed.where("leaf is not null").select(
        "row", "size", F.col("leaf").alias("shard_depth"), bits.alias("shard")
    )
    if lower < HASH_BITS:
        return fits
    # written, so that a row's part and place stay what they are
    left = cut(placed.where("leaf is null").select("row", "size", "h"))
    left = left.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    own = Window.partitionBy("h", "part").orderBy("place")
    pages = left.select("row", "size", "h", "part", (F.row_number().over(own) - 1).alias("nth")).select(
        "row",
        "size",
        F.lit(HASH_BITS).alias("shard_depth"),
        F.concat_ws(
            "-",
            F.lpad(F.bin("h"), HASH_BITS, "0"),
            F.col("part").cast("string"),
            F.expr(f"nth div greatest(1, {max_bytes} div size)").cast("string"),
        ).alias("shard"),
    )
    return fits.unionByName(pages)


def with_shards(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs`` and, after them, ``shard``; an existing column of that name is replaced."""
    kept = [c for c in docs.columns if c != "shard"]
    return extendible_shards(docs, **options).select(*[F.col("row")[c].alias(c) for c in kept], "shard")


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """One folder per shard; a shard is within the limit, so each is written by one task."""
    with_shards(docs, **options).repartition("shard").write.partitionBy("shard").parquet(path)
