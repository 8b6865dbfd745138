"""Check plan: records -> annotated rows -> the report DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..operators.reports import data_invalid, not_loadable, rows_stats
from ..operators.rowchecks import annotate, normalise, typed_valid
from ..rules import PIPELINE_NAME, TableRules


def now_utc() -> str:
    """One ingestion time per table run, second precision (never per row)."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


@dataclass
class CheckResult:
    rows_stats: DataFrame
    data_invalid: DataFrame
    valid: DataFrame
    annotated: DataFrame
    not_loadable: DataFrame  # cells of valid rows that load as null
    file_stats: DataFrame | None = None
    cached: list[DataFrame] = field(default_factory=list)
    staged: list[str] = field(default_factory=list)

    def release(self) -> None:
        """Drop cached frames and staged tables once the outputs are written."""
        for df in self.cached:
            df.unpersist()
        self.cached.clear()
        if self.staged:
            from ..session import delete_path

            spark = self.rows_stats.sparkSession
            for path in self.staged:
                delete_path(spark, path)
            self.staged.clear()


MATERIALIZE = ("persist", "stage", "none")


def materialize(df: DataFrame, how: str, name: str) -> tuple[DataFrame, list[DataFrame], list[str]]:
    """Compute ``df`` once for several consumers.

    persist: executor memory/disk; a lost executor's blocks are recomputed
    from lineage. stage: a parquet table in the shared checkpoint folder
    (spark.checkpoint.dir), read back; lineage is cut, so a lost executor
    costs nothing to recompute. none: every consumer recomputes.
    """
    if how == "persist":
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        return df, [df], []
    if how == "stage":
        from ..session import new_scratch_path

        path = new_scratch_path(df.sparkSession, name)
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path), [], [path]
    if how == "none":
        return df, [], []
    raise ValueError(f"materialize must be one of {MATERIALIZE}")


def check_records(
    records: DataFrame,
    rules: TableRules,
    *,
    pipeline: str = PIPELINE_NAME,
    dataset: str = "raw",
    table: str = "table",
    ingest_ts: str | None = None,
    files: DataFrame | None = None,
    persist: bool = True,
    cache_input: bool = True,
    materialize_as: str | None = None,
    spread_rows: bool | None = False,
    files_small: bool = False,
) -> CheckResult:
    """Run the row checks over all files of a table at once.

    ``files`` lists the readable files (``source_filename``) so that files
    without data rows still get a zero ``rows_stats`` row.

    ``cache_input``: the records are read twice (key-count job, check job);
    materialize them once unless they already come from a cached scan. They
    are released as soon as the annotated rows are materialized.

    ``materialize_as`` (persist / stage / none) says how the annotated rows
    are kept for the three outputs; by default ``persist`` if ``persist``
    else ``none``.

    ``spread_rows``: True runs the checks on a round-robin repartition of the
    records (for inputs narrower than the cluster); None decides from the
    records' partition count, which plans the records (only cheap for plain
    scans; ``table_records`` and ``check_landing`` decide this themselves).
    """
    ts = ingest_ts or now_utc()
    if cache_input:
        records = records.persist(StorageLevel.MEMORY_AND_DISK)
    norm = normalise(records, rules, ts)
    annotated, cached = annotate(norm, rules, spread_rows=spread_rows)
    how = materialize_as or ("persist" if persist else "none")
    # Three outputs read the annotated rows: compute the checks once.
    annotated, kept, staged = materialize(annotated, how, "annotated")
    cached = cached + kept
    if cache_input:
        if how == "persist":
            annotated.count()
        if how in ("persist", "stage"):
            records.unpersist()
        else:
            cached = cached + [records]
    return CheckResult(
        rows_stats=rows_stats(annotated, pipeline, dataset, table, ts, files, files_small),
        data_invalid=data_invalid(annotated, pipeline, dataset, table, ts),
        valid=typed_valid(annotated, rules),
        annotated=annotated,
        not_loadable=not_loadable(annotated, rules, pipeline, dataset, table, ts),
        cached=cached,
        staged=staged,
    )
