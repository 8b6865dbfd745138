"""What a run has done, so that the same run can be repeated after a kill.

A run's entries are small files under ``<root>/_runs/<run>/`` (Spark takes them for no
data). ``append_once`` writes rows aside and, once they are complete, moves their files
into the table under names that say run and entry; a repeated run goes on with the files
that have not moved, or finds the entry and does nothing. So rows are appended once,
wherever the run was cut off. Two runs of the same name must not go on at once.

Needs paths on a file system that renames files at once, as ``swap`` does.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

from . import swap
from .sinks import in_table_order, table_exists


class Ledger:
    def __init__(self, spark: SparkSession, root: str, run: str):
        if not re.fullmatch(r"[A-Za-z0-9.-]+", run):
            raise ValueError("a run's name may hold letters, digits, '.' and '-' only")
        self.spark, self.run, self.folder = spark, run, f"{root.rstrip('/')}/_runs/{run}"
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def read(self, entry: str) -> str | None:
        """What was noted under an entry; None if nothing was."""
        fs, path = self._at(f"{self.folder}/{entry}")
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def note(self, entry: str, text: str) -> None:
        """Note an entry; it is there with its whole text or not at all."""
        fs, path = self._at(f"{self.folder}/{entry}")
        _, aside = self._at(f"{self.folder}/{entry}.writing")
        stream = fs.create(aside, True)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        if not fs.rename(aside, path):
            raise OSError(f"cannot note {path}")

    def once(self, entry: str, text: str) -> str:
        """The entry's text, which is ``text`` for the first to ask."""
        there = self.read(entry)
        if there is None:
            self.note(entry, text)
            return text
        return there

    def _move(self, aside: str, target: str, entry: str) -> None:
        fs, path = self._at(aside)
        fs.mkdirs(self._at(target)[1])
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            if name.startswith("part-") and not fs.rename(status.getPath(), self._at(f"{target}/{self.run}-{entry}-{name}")[1]):
                raise OSError(f"cannot move {status.getPath()}")

    def append_once(self, df: DataFrame, target: str, entry: str) -> bool:
        """Append the rows unless this run has done so; whether it did now."""
        if not swap.is_path(target):
            raise ValueError("appends that can be repeated need a path")
        if self.read(entry) is not None:
            return False
        parent, name = os.path.split(target.rstrip("/"))
        aside = f"{parent}/_{name}.append-{self.run}-{entry}"
        fs, success = self._at(f"{aside}/_SUCCESS")
        if not fs.exists(success):  # nothing has moved yet
            fs.delete(self._at(aside)[1], True)
            if table_exists(self.spark, target):
                df = in_table_order(df, target)
            df.write.parquet(aside)
        self._move(aside, target, entry)
        self.note(entry, "appended")
        fs.delete(self._at(aside)[1], True)
        return True
