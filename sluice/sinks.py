"""Sinks (K1-K4): report tables (append), typed table (append / truncate), CSV export.

A target is either a catalog table name (``db.table``) or a storage path
(anything with a '/'), written as parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import swap
from .rules import WRITE_MODES
from .schemas import DATA_INVALID, FILE_STATS, ROWS_STATS


class SchemaMismatch(ValueError):
    """Rows do not have the columns or types of the table that they should join."""



def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fixed column order and types of a report table."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def table_exists(spark: SparkSession, target: str) -> bool:
    swap.finish(spark, target)
    if not swap.is_path(target):
        return spark.catalog.tableExists(target)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target.rstrip("/") + "/*.parquet")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return bool(found)


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """A loaded table; a replacement that a lost driver left unfinished is finished first."""
    swap.finish(spark, target)
    return spark.read.parquet(target) if swap.is_path(target) else spark.table(target)


def in_table_order(df: DataFrame, target: str) -> DataFrame:
    """``df`` with its columns in the order of the existing table; SchemaMismatch,
    before anything is written, unless names and types are the table's."""
    types = lambda schema: {f.name: f.dataType.simpleString() for f in schema.fields}
    there, given = types(read_table(df.sparkSession, target).schema), types(df.schema)
    if there != given:
        wrong = [f"{c}: {there.get(c, 'no column')} in the table, {given.get(c, 'no column')} in the rows" for c in sorted(there | given) if there.get(c) != given.get(c)]
        raise SchemaMismatch(f"{target}: " + "; ".join(wrong))
    return df.select(*[F.col(f"`{c}`") for c in there])


def write_table(df: DataFrame, target: str, write_mode: str) -> None:
    """APPEND: the rows join the table, whose columns and types they must have.
    TRUNCATE: they take its place, all at once or, if the load fails, not at all."""
    if write_mode == "TRUNCATE":
        swap.replace(df, target)
        return
    if table_exists(df.sparkSession, target):
        df = in_table_order(df, target)
    if swap.is_path(target):
        df.write.mode("append").parquet(target)
    else:
        df.write.mode("append").saveAsTable(target)


def append_reports(result, file_stats: str, rows_stats: str, data_invalid: str, once=None, name: str = "") -> None:
    """K2: append the three reports (tables are created on first write). ``data_invalid`` also
    gets the cells of valid rows that load as null.

    ``once``: a ``Ledger``; each report is then appended once in its run, under ``name``."""
    reports = [("rows_stats", result.rows_stats, ROWS_STATS, rows_stats), ("data_invalid", result.data_invalid.unionByName(result.not_loadable), DATA_INVALID, data_invalid)]
    if result.file_stats is not None:
        reports.insert(0, ("file_stats", result.file_stats, FILE_STATS, file_stats))
    for report, df, schema, target in reports:
        if once is not None:
            once.append_once(conform(df, schema), target, f"{name}-{report}")
        else:
            write_table(conform(df, schema), target, "APPEND")


def load_valid(valid: DataFrame, target: str, write_mode: str, once=None, name: str = "") -> bool:
    """K3 + K4: load typed valid rows; no rows means no write (TRUNCATE keeps
    the old table). A load that fails leaves the table as it was. Returns
    whether anything was written. ``once``: a ``Ledger``; rows are then appended
    once in its run, under ``name``."""
    if write_mode not in WRITE_MODES:
        raise ValueError(f"write_mode must be one of {WRITE_MODES}, got {write_mode!r}")
    if valid.isEmpty():
        return False
    if once is not None and write_mode == "APPEND":
        once.append_once(valid, target, f"{name}-valid")
    else:
        write_table(valid, target, write_mode)
    return True


# --- fixed values: text forms of the reference's CSV report files ----------
EXPORT_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
EXPORT_TRUE, EXPORT_FALSE = "True", "False"
# quotes doubled, blanks kept
EXPORT_OPTIONS = {
    "header": "true", "sep": ";", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
# --------------------------------------------------------------------------


def export_csv(df: DataFrame, path: str, order_by: list[str] | None = None, drop: list[str] | None = None) -> None:
    """K1: ';'-separated CSV with a header (report export); optional total order
    (range-partitioned sort, O1/O2). Timestamps and booleans are written as the
    reference's report files show them."""
    if order_by:
        df = df.orderBy(*order_by)
    df = df.drop(*(drop or ()))  # columns that only order the rows
    df = df.select(
        *[
            F.when(F.col(f.name), EXPORT_TRUE).when(~F.col(f.name), EXPORT_FALSE).alias(f.name)
            if isinstance(f.dataType, T.BooleanType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    (
        df.write.mode("overwrite").options(**EXPORT_OPTIONS)
        .option("timestampFormat", EXPORT_TIMESTAMP_FORMAT)
        .option("timestampNTZFormat", EXPORT_TIMESTAMP_FORMAT)
        .csv(path)
    )
