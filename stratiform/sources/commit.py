"""Whole years of several tables, replaced together: a two-phase commit.

A run writes every table to its own folder below ``<root>/_runs`` (a name that
Spark's readers skip), so until the commit no reader sees anything of it.  The
commit first writes a *journal*: which years of which tables are replaced, and
which of them have rows.  Creating that one file decides the run; a run killed
before it leaves the old state.  Then each year's folder is swapped: the old one
is deleted, the new one renamed into place, and a year without rows is gone.  A
run killed in between is finished by whoever opens the root next (``recover``):
every step is repeatable.

A year is replaced even when the run has no row for it; dynamic partition
overwrite, which goes by the rows it sees, would keep the old ones.  The schema
of each table lies beside its data, so that a table with no year left still
reads as an empty one.

One writer at a time: a second commit finds the journal and stops.  File moves
go through Hadoop's file systems, one call a year and table on the driver; no
data passes it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.schema import YEAR

RUNS = "_runs"
JOURNAL = "_journal.json"
SCHEMA = "_schema.json"


class Folders:
    """The few file operations of a commit, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        self.fs.mkdirs(self._path(target).getParent())
        if not self.fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def names(self, path: str) -> list[str]:
        """Names of the folders inside ``path``."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(path)) if s.isDirectory())

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str, replace: bool = True) -> None:
        """The whole file or nothing; without ``replace`` it must be new."""
        target = self._path(path)
        self.fs.mkdirs(target.getParent())
        draft = self._path(f"{path}.{uuid.uuid4().hex}")
        stream = self.fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if replace:
            self.fs.delete(target, False)
        elif self.fs.exists(target):
            self.fs.delete(draft, False)
            raise FileExistsError(path)
        if not self.fs.rename(draft, target):
            raise FileExistsError(path)


def journal_path(root: str) -> str:
    return f"{root.rstrip('/')}/{RUNS}/{JOURNAL}"


def recover(spark: SparkSession, root: str) -> bool:
    """Finish a commit that was cut off after its journal; whether one was."""
    folders = Folders(spark, root)
    if not folders.exists(journal_path(root)):
        return False
    _swap(folders, root, json.loads(folders.read(journal_path(root))))
    return True


def _swap(folders: Folders, root: str, journal: dict) -> None:
    run = f"{root.rstrip('/')}/{RUNS}/{journal['run']}"
    for entry in journal["years"]:
        target = f"{root.rstrip('/')}/{entry['table']}/{entry['folder']}"
        staged = f"{run}/{entry['table']}/{entry['folder']}"
        if not entry["rows"]:
            folders.delete(target)
        elif folders.exists(staged):  # else this year was swapped before the cut
            folders.delete(target)
            folders.move(staged, target)
    for table, schema in journal["schemas"].items():
        folders.write(f"{root.rstrip('/')}/{table}/{SCHEMA}", schema)
    folders.delete(run)
    folders.delete(journal_path(root))


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    folders = Folders(spark, path)
    place = f"{path.rstrip('/')}/{SCHEMA}"
    return T.StructType.fromJson(json.loads(folders.read(place))) if folders.exists(place) else None


class YearCommit:
    """One run's replacement of ``years`` in tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str, years: list[int]) -> None:
        recover(spark, root)
        self.spark, self.root, self.years = spark, root.rstrip("/"), sorted(set(years))
        self.run = uuid.uuid4().hex
        self.tables: dict[str, tuple[str, T.StructType]] = {}

    def staged(self, table: str) -> str:
        return f"{self.root}/{RUNS}/{self.run}/{table}"

    def write(self, df: DataFrame, table: str, by: str = YEAR, order: list[str] | None = None) -> None:
        """Write a table of this run, partitioned by year.  With ``order`` the
        rows are clustered: a file holds a range of (year, first column), sorted
        by all of them with NULLs last, and names follow the ranges.  A global
        sort would not last: the partitioned write sorts by year again."""
        kept = [f for f in df.schema.fields if f.name != by] + [df.schema[by]]  # as Parquet folders give them back
        self.tables[table] = (by, T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in kept]))
        if order:
            keys = [F.col(by), *[F.col(c).asc_nulls_last() for c in order]]
            df = df.repartitionByRange(*keys[:2]).sortWithinPartitions(*keys)
        df.write.mode("overwrite").partitionBy(by).parquet(self.staged(table))

    def read(self, table: str) -> DataFrame:
        """A table of this run, before the commit."""
        return self.spark.read.schema(self.tables[table][1]).parquet(self.staged(table))

    def prepare(self) -> None:
        """First phase: the journal.  From here on the run counts."""
        folders = Folders(self.spark, self.root)
        entries = []
        for table, (by, _) in self.tables.items():
            found = set(folders.names(self.staged(table)))
            wanted = {f"{by}={y}" for y in self.years}
            other = {f for f in found if f.startswith(f"{by}=")} - wanted
            if other:
                raise ValueError(f"{table}: rows of {sorted(other)}, but this run replaces {self.years}")
            entries += [{"table": table, "folder": f, "rows": f in found} for f in sorted(wanted)]
        schemas = {table: schema.json() for table, (_, schema) in self.tables.items()}
        folders.write(journal_path(self.root), json.dumps({"run": self.run, "years": entries, "schemas": schemas}), replace=False)

    def commit(self) -> None:
        self.prepare()
        recover(self.spark, self.root)

    def abandon(self) -> None:
        """Drop what was written; the old state stays."""
        Folders(self.spark, self.root).delete(f"{self.root}/{RUNS}/{self.run}")
