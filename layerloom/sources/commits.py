"""Sets of tables that become visible together.

A commit is one small file, ``_commits/<sequence>.json`` under a root, that names
the folders of every table of the set, with its schema and whatever facts a later
run needs of it. It is written aside and renamed into place, which fails if the
name is taken (atomic on HDFS and local file systems; an object store needs a
committer or lock table for that step). Readers take the highest sequence number,
so they see all tables of one commit or of the one before, and folders that no
commit names yet are not looked at. A writer says which commit it started from; if
another came first, it gets ``CommitConflict`` and has changed nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FOLDER = "_commits"
DIGITS = 20


class CommitConflict(RuntimeError):
    """Another writer has committed since the commit this one started from."""


@dataclass(frozen=True)
class TableEntry:
    """Folders of a table's rows, its schema as JSON, and facts such as its highest key."""

    paths: tuple[str, ...]
    schema: str
    facts: dict = field(default_factory=dict)

    @classmethod
    def of(cls, df: DataFrame, *paths: str, **facts) -> TableEntry:
        return cls(tuple(paths), df.schema.json(), facts)

    def read(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.schema))
        if not self.paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*self.paths)


@dataclass(frozen=True)
class Commit:
    sequence: int
    run_id: str
    tables: dict[str, TableEntry]

    def read(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {name: entry.read(spark) for name, entry in self.tables.items()}


class CommitLog:
    """The commits under ``root``, on any file system Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.folder = self._path(f"{self.root}/{FOLDER}")
        self.fs = self.folder.getFileSystem(self.conf)

    def _path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def _file(self, sequence: int):
        return self._path(f"{self.root}/{FOLDER}/{sequence:0{DIGITS}d}.json")

    def sequences(self) -> list[int]:
        """Sequence numbers of the commits that are kept, ascending."""
        if not self.fs.exists(self.folder):
            return []
        names = [status.getPath().getName() for status in self.fs.listStatus(self.folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:DIGITS].isdigit())

    def read(self, sequence: int | None = None) -> Commit | None:
        """A commit by its number, or the latest; None if there is none yet."""
        kept = self.sequences()
        if sequence is None:
            if not kept:
                return None
            sequence = kept[-1]
        if sequence not in kept:
            raise FileNotFoundError(f"no commit {sequence} under {self.root}; kept are {kept}")
        stream = self.fs.open(self._file(sequence))
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        tables = {
            name: TableEntry(tuple(e["paths"]), e["schema"], e["facts"]) for name, e in found["tables"].items()
        }
        return Commit(found["sequence"], found["run_id"], tables)

    def before(self, run_id: str) -> tuple[Commit | None, int]:
        """What a run starts from: the last commit before its own first one, and how many it has made itself."""
        base, own = None, 0
        for sequence in self.sequences():
            found = self.read(sequence)
            if found.run_id == run_id:
                own += 1
            elif not own:
                base = found
        return base, own

    def put(self, run_id: str, tables: Mapping[str, TableEntry], after: int | None = None) -> Commit:
        """Make ``tables`` the current set; ``after`` is the sequence number that must still be the latest."""
        kept = self.sequences()
        latest = kept[-1] if kept else 0
        if after is not None and after != latest:
            raise CommitConflict(f"commit {latest} came after {after} under {self.root}")
        made = Commit(latest + 1, run_id, dict(tables))
        self.fs.mkdirs(self.folder)
        aside = self._path(f"{self.root}/{FOLDER}/.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(aside, False)
        try:
            stream.write(bytearray(json.dumps(asdict(made), sort_keys=True).encode()))
        finally:
            stream.close()
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.folder.toUri(), self.conf)
        try:
            context.rename(aside, self._file(made.sequence), how)
        except Py4JJavaError as error:
            self.fs.delete(aside, False)
            if "FileAlreadyExists" in str(error.java_exception):
                raise CommitConflict(f"commit {made.sequence} was made meanwhile under {self.root}") from None
            raise
        return made

    def expire(self, keep: int) -> list[str]:
        """Forget all but the last ``keep`` commits and delete the folders that only those named."""
        if keep < 1:
            raise ValueError("the latest commit stays")
        kept = self.sequences()
        old, new = kept[:-keep], kept[-keep:]
        named = {p for s in new for e in self.read(s).tables.values() for p in e.paths}
        gone = sorted({p for s in old for e in self.read(s).tables.values() for p in e.paths} - named)
        for sequence in old:  # first the commits, so that none names what is deleted
            self.fs.delete(self._file(sequence), False)
        for path in gone:
            folder = self._path(path)
            folder.getFileSystem(self.conf).delete(folder, True)
        return gone
