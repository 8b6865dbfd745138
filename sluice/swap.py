"""Replacing a whole table so that readers see the old rows or the new ones, never neither.

The new rows are written aside; only when all of them are there does the table
change, by renames that a restart can finish:

    writing -> ready     the new rows are complete: from here on the load counts as done
    table   -> old
    ready   -> table
    old is dropped

``finish`` goes on from whatever state a lost driver left behind; every load and every
read through ``sinks`` calls it first. A load that fails before ``ready`` leaves the table
as it was. One writer a table at a time (the registry run has one).

A path target needs a file system that renames folders at once (HDFS, local disks, object stores
with a directory tree); on a plain object store use a catalog table. A catalog
target is renamed in its catalog; managed and external tables both work that way.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

ROLES = ("writing", "ready", "old")


def is_path(target: str) -> bool:
    return "/" in target


class _Folders:
    """A parquet folder and its neighbours ``_<name>.<role>``, which Spark takes for no data."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def name(self, role: str | None) -> str:
        parent, base = os.path.split(self.target)
        return f"{parent}/_{base}.{role}" if role else self.target

    def _path(self, role: str | None):
        path = self.jvm.org.apache.hadoop.fs.Path(self.name(role))
        return path.getFileSystem(self.conf), path

    def exists(self, role: str | None) -> bool:
        fs, path = self._path(role)
        return fs.exists(path)

    def drop(self, role: str) -> None:
        fs, path = self._path(role)
        fs.delete(path, True)

    def rename(self, role: str | None, to: str | None) -> None:
        fs, path = self._path(role)
        if not fs.rename(path, self._path(to)[1]):
            raise OSError(f"cannot rename {self.name(role)} to {self.name(to)}")

    def write(self, df: DataFrame, role: str) -> None:
        df.write.parquet(self.name(role))


class _Tables:
    """A catalog table and its neighbours ``<table>__<role>``."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target

    def name(self, role: str | None) -> str:
        return f"{self.target}__{role}" if role else self.target

    def exists(self, role: str | None) -> bool:
        return self.spark.catalog.tableExists(self.name(role))

    def drop(self, role: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(role)}")

    def rename(self, role: str | None, to: str | None) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(role)} RENAME TO {self.name(to)}")

    def write(self, df: DataFrame, role: str) -> None:
        df.write.saveAsTable(self.name(role))


def _store(spark: SparkSession, target: str) -> _Folders | _Tables:
    return _Folders(spark, target) if is_path(target) else _Tables(spark, target)


def _swap(store: _Folders | _Tables) -> Iterator[str]:
    """From ``ready`` on to the end, or nothing if there is no ``ready``; yields after each step."""
    if store.exists("ready"):
        if store.exists(None):
            if store.exists("old"):  # left over from a swap that ended but for this
                store.drop("old")
            store.rename(None, "old")
            yield "old"
        store.rename("ready", None)
        yield "table"
    elif store.exists("old") and not store.exists(None):
        store.rename("old", None)
    if store.exists("old"):
        store.drop("old")
        yield "dropped"


def finish(spark: SparkSession, target: str) -> None:
    """Finish a replacement that was cut off after its rows were complete."""
    for _ in _swap(_store(spark, target)):
        pass


def replace_steps(df: DataFrame, target: str) -> Iterator[str]:
    """The steps of a replacement, each done when its name is yielded."""
    store = _store(df.sparkSession, target)
    finish(df.sparkSession, target)
    store.drop("writing")
    try:
        store.write(df, "writing")
    except Exception:
        store.drop("writing")
        raise
    store.rename("writing", "ready")
    yield "ready"
    yield from _swap(store)


def replace(df: DataFrame, target: str) -> None:
    """The rows of ``df`` become the table ``target``; ``df`` may read the old table."""
    for _ in replace_steps(df, target):
        pass
