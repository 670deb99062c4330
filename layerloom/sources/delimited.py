"""Delimited landing files as all-text frames."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.functions.text import snake_case_columns
from layerloom.operators.quality import Rule
from layerloom.sources.specs import SourceSpec


# A record whose number of fields is not its file's: the text of it; NULL for all others.
MALFORMED = "malformed_record"
WELL_FORMED = Rule("malformed record", f"{MALFORMED} IS NOT NULL")

#: Bytes of a file that its header is first looked for in; a longer header is read on.
HEAD_BYTES = 16_384
#: Files that the driver has open at once to read their headers.
OPEN_AT_ONCE = 32
#: A record up to the line break that ends it; line breaks in quotes are part of it.
_RECORD = re.compile(r'(?:[^"\r\n]|"[^"]*+")*+(?=[\r\n])')


def _scan(spark: SparkSession, paths: str | list[str], columns: Sequence[str], spec: SourceSpec) -> DataFrame:
    """All columns as text. No inference: it costs a pass and makes types depend on the data."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, MALFORMED)])
    reader = spark.read.options(
        header=True, quote='"', escape='"', multiLine=spec.multiline, columnNameOfCorruptRecord=MALFORMED
    )
    rows = reader.option("columnPruning", False).schema(schema).csv(paths)
    return rows.select("*", F.col("_metadata.file_name").alias("source_file_name"))


def read_by_position(spark: SparkSession, path: str, spec: SourceSpec) -> DataFrame:
    """Columns by their place in the file; header texts are ignored."""
    return _scan(spark, path, spec.columns, spec)


def header_fields(text: str, whole: bool) -> tuple[str, ...] | None:
    """Fields of the first record that is not blank; None if it may go on behind ``text``, not the ``whole`` file."""
    text = text.lstrip(" \t\r\n")
    ended = _RECORD.match(text)
    if not ended and not whole:
        return None
    record = ended[0] if ended else text
    return tuple(next(csv.reader(io.StringIO(record, newline="")), []))


def _header(spark: SparkSession, file: str) -> tuple[str, tuple[str, ...]]:
    """A file's path and header, of which only the first bytes are read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    try:
        stream = codec.createInputStream(stream) if codec else stream
        head, size = b"", HEAD_BYTES
        while True:
            more = bytes(stream.readNBytes(size))
            head += more
            fields = header_fields(head.decode("utf-8-sig", "ignore"), whole=len(more) < size)
            if fields is not None:
                return path.toString(), fields
            size = len(head)  # doubles what is held
    finally:
        stream.close()


def _files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files under ``path`` by header; blank files have none. Some are open at a time, none is scanned."""
    files = sorted(spark.read.text(path).inputFiles())
    found: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(OPEN_AT_ONCE) as pool:
        for file, header in pool.map(lambda f: _header(spark, f), files):
            if header:
                found.setdefault(header, []).append(file)
    return found


def read_by_header(spark: SparkSession, path: str, spec: SourceSpec) -> DataFrame:
    """Columns by normalised header of each file; extra ones are dropped, missing ones are an error."""
    out = None
    for header, files in _files_by_header(spark, path).items():
        rows = snake_case_columns(_scan(spark, files, header, spec))
        missing = [c for c in spec.columns if c not in rows.columns]
        if missing:
            raise ValueError(f"{files[0]} lacks columns {missing}; it has {list(header)}")
        rows = rows.select(*spec.columns, MALFORMED, "source_file_name")
        out = rows if out is None else out.unionByName(rows)
    return _scan(spark, path, spec.columns, spec) if out is None else out


def with_lineage(df: DataFrame, run_id: str, ingested_at: datetime) -> DataFrame:
    """Add run id and load time; the file name comes from the reader."""
    return df.withColumns(
        {
            "pipeline_run_id": F.lit(run_id),
            "ingested_at": F.lit(str(ingested_at)).cast("timestamp_ntz"),
        }
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Export as a folder of CSV parts, each with a header, written by the executors."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
