"""Helpers shared by the operators: tables, staged tables, let-bindings, row identity."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, new_scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: cuts the
    lineage and survives the loss of any executor. The driver's garbage is then
    collected, so that Spark's cleaner drops the shuffle files behind the table."""
    spark, schema = df.sparkSession, df.schema
    path = new_scratch_path(spark, name)
    df.write.parquet(path)
    del df
    gc.collect()
    for _ in range(2):  # the write's last events still hold its plan
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
    read = spark.read.schema(schema).parquet(path)
    read.staged_at = path
    return read


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        delete_path(df.sparkSession, df.staged_at)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they run (once an application)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="sluice-code-"), "sluice-code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once: inside a lambda the optimizer cannot copy it into each use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def window_hashes(words: Column, size: int) -> Column:
    """Hash of each run of ``size`` words: of words, then of pairs, fours, ... that overlap."""
    def wider(hashes: Column, width: int) -> Column:
        if width == size:
            return hashes
        step = min(width, size - width)

        def join(h: Column) -> Column:
            pairs = F.transform(F.slice(h, F.lit(1), F.size(h) - step), lambda x, i: F.xxhash64(x, F.get(h, i + step)))
            return wider(pairs, width + step)

        return let(hashes, join)

    start = F.transform(words, lambda x: F.xxhash64(x))
    return F.when(F.size(words) >= size, wider(start, 1)).otherwise(F.array().cast("array<bigint>"))


def whole_text(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


def uniform(key: Column, salt: str = "") -> Column:
    """A number in [0, 1) that depends on the key's text alone (52 bits of an MD5)."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(salt)).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def only(docs: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns under the operator's own names: whatever else a
    table carries can then not clash with a name used inside."""
    return docs.select(*[F.col(f"`{given}`").alias(own) for own, given in columns.items()])
