"""Report DataFrames (data_invalid, rows_stats) from the annotated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..rules import TableRules
from ..schemas import CODE_KEY, CODE_NULL, CODE_PARSE
from .rowchecks import FILE, INDEX, VIOLATIONS, ingest_text, lost_values


def _ts(ingest_ts) -> Column:
    return F.lit(ingest_text(ingest_ts)).cast("timestamp_ntz")


def not_loadable(annotated: DataFrame, rules: TableRules, pipeline: str, dataset: str, table: str, ingest_ts) -> DataFrame:
    """Cells of valid rows that the typed table can only hold as null, in the schema of ``data_invalid``."""
    return data_invalid(annotated.withColumn(VIOLATIONS, lost_values(rules)), pipeline, dataset, table, ingest_ts)


def data_invalid(annotated: DataFrame, pipeline: str, dataset: str, table: str, ingest_ts) -> DataFrame:
    """One row per (row, rule, column) violation, fixed schema order."""
    # explode emits nothing for an empty array: no filter needed. Of a plain column Spark
    # would infer one (its size is not 0) and push it below the parse projections, where it evaluates
    # all of them again, inlined; an expression over the column is left alone.
    some = F.when(F.size(VIOLATIONS) > 0, F.col(VIOLATIONS))
    return (
        annotated.select(FILE, INDEX, F.explode(some).alias("_v"))
        .select(
            F.lit(pipeline).alias("pipeline"),
            F.lit(dataset).alias("dataset"),
            F.lit(table).alias("table"),
            F.col(FILE),
            F.col(INDEX),
            F.col("_v.invalid_reason").alias("invalid_reason"),
            F.col("_v.invalid_code").alias("invalid_code"),
            F.col("_v.invalid_col_name").alias("invalid_col_name"),
            F.col("_v.invalid_col_value").alias("invalid_col_value"),
            _ts(ingest_ts).alias("date_ingest"),
        )
    )


def _has_code(code: str) -> Column:
    return F.array_contains(F.col(VIOLATIONS)["invalid_code"], code)


def row_counts(annotated: DataFrame) -> DataFrame:
    """Per-file counts at row grain (a row counts once per code)."""
    n = F.size(VIOLATIONS)
    return annotated.groupBy(FILE).agg(
        F.count_if(n == 0).alias("nb_valid_lines"),
        F.count_if(n > 0).alias("nb_invalid_lines"),
        F.count_if(_has_code(CODE_NULL)).alias(f"nb_invalid_lines_{CODE_NULL}"),
        F.count_if(_has_code(CODE_KEY)).alias(f"nb_invalid_lines_{CODE_KEY}"),
        F.count_if(_has_code(CODE_PARSE)).alias(f"nb_invalid_lines_{CODE_PARSE}"),
    )


COUNT_COLUMNS = (
    "nb_valid_lines",
    "nb_invalid_lines",
    f"nb_invalid_lines_{CODE_NULL}",
    f"nb_invalid_lines_{CODE_KEY}",
    f"nb_invalid_lines_{CODE_PARSE}",
)


def rows_stats(
    annotated: DataFrame,
    pipeline: str,
    dataset: str,
    table: str,
    ingest_ts,
    files: DataFrame | None = None,
    files_small: bool = False,
) -> DataFrame:
    """A3-A6. ``files`` (one ``source_filename`` per readable file) adds zero rows
    for files that produced no data rows (header only, all rows blank).
    ``files_small``: the caller bounded the file count, so the per-file counts
    are broadcast instead of shuffled for the join."""
    counts = row_counts(annotated)
    if files is not None:
        counts = files.select(FILE).join(F.broadcast(counts) if files_small else counts, FILE, "left")
    return counts.select(
        F.lit(pipeline).alias("pipeline"),
        F.lit(dataset).alias("dataset"),
        F.lit(table).alias("table"),
        F.col(FILE),
        _ts(ingest_ts).alias("date_ingest"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in COUNT_COLUMNS],
    )
