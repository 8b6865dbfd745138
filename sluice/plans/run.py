"""Table-registry run: every enabled table (in turn, or a few at once), work on the executors."""

from __future__ import annotations

import json
import logging
import threading
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..ledger import Ledger
from ..operators.rowchecks import typed_valid
from ..rules import RunConfig, TableRules
from ..sinks import append_reports, export_csv, load_valid
from .landing import check_landing
from .validate import now_utc

log = logging.getLogger(__name__)
_REPORT_LOCK = threading.Lock()


@dataclass
class TableRun:
    name: str
    ingest_ts: str
    loaded: bool = False
    files: int = 0
    invalid_files: int = 0
    error: str | None = None
    repeated: bool = False  # done by an earlier run of the same run_id


def target(root: str, dataset: str, table: str) -> str:
    """Storage path of a table, or a catalog name when no root is given."""
    return f"{root.rstrip('/')}/{dataset}/{table}" if root else f"{dataset}.{table}"


def run_landing(
    spark: SparkSession,
    config: RunConfig,
    landing_root: str,
    output_root: str | None = None,
    export_root: str | None = None,
    multi_line: bool | None = None,
    materialize_as: str = "stage",
    parallel_tables: int = 1,
    run_id: str | None = None,
    **check_options,
) -> list[TableRun]:
    """Check, report and load every enabled table of the registry.

    A table with ``to_request: False`` is skipped. Reports are appended; the
    typed valid rows are appended or replace the table (write_mode), but only
    when there is at least one valid row. One table's failure does not stop
    the others. The checked rows are staged once in the shared checkpoint
    folder (``materialize_as='stage'``) and the outputs are written from
    there, so losing an executor mid-run does not redo the scan and shuffle.

    ``parallel_tables`` > 1 submits several tables' jobs at once from driver
    threads (independent tables, one scheduler): many small tables then
    share the cluster instead of running one after another.

    ``run_id`` names the run, so that it can be repeated after a kill (needs ``output_root``): what
    it has appended is not appended again, tables it has finished are left alone, and a
    table keeps its first ingestion time (see ``ledger``). Other keyword
    options (``cache_scan``) go to ``check_landing``.
    """
    ledger = None
    if run_id is not None:
        if not output_root:
            raise ValueError("a run that can be repeated needs output_root")
        ledger = Ledger(spark, f"{output_root.rstrip('/')}/{config.quality_dataset}", run_id)
    tables = []
    for t in config.tables:
        if not t.to_request:
            log.info("table %s skipped (to_request is false)", t.name)
        else:
            tables.append(t)

    def one(t) -> TableRun:
        return _run_table(
            spark, config, t, landing_root, output_root, export_root, multi_line, materialize_as,
            check_options, ledger,
        )

    if parallel_tables > 1 and len(tables) > 1:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=parallel_tables) as pool:
            return list(pool.map(one, tables))
    return [one(t) for t in tables]


def _run_table(
    spark, config, t, landing_root, output_root, export_root, multi_line, materialize_as,
    check_options, ledger=None,
) -> TableRun:
    ts = now_utc()
    if ledger is not None:
        done = ledger.read(f"{t.name}-done")
        if done is not None:
            return TableRun(**json.loads(done), repeated=True)
        ts = ledger.once(f"{t.name}-time", ts)
    res = None
    # Thread-local: with parallel tables each thread labels its own jobs.
    spark.sparkContext.setJobDescription(f"sluice {t.name}")
    try:
        rules = TableRules.load(t.rules_file)
        res = check_landing(
            spark, landing_root, rules, pipeline=config.pipeline_name, dataset=t.dataset,
            table=t.table, ingest_ts=ts, multi_line=multi_line, materialize_as=materialize_as,
            **check_options,
        )
        with _REPORT_LOCK:  # the report tables are shared by all tables of the run
            append_reports(
                res,
                target(output_root, config.quality_dataset, config.file_stats_table),
                target(output_root, config.quality_dataset, config.rows_stats_table),
                target(output_root, config.quality_dataset, config.data_invalid_table),
                once=ledger, name=t.name,
            )
        if export_root:
            base = f"{export_root.rstrip('/')}/data_quality/{t.name}"
            export_csv(res.file_stats, f"{base}/file_stats")
            export_csv(res.rows_stats, f"{base}/rows_stats")
            export_csv(res.data_invalid, f"{base}/data_invalid", ["table", "source_filename", "index"])
            in_order = typed_valid(res.annotated, rules, extra=("_file", "_index"))
            export_csv(in_order, f"{base}/data_valid", ["_file", "_index"], drop=["_file", "_index"])
        loaded = load_valid(res.valid, target(output_root, t.dataset, t.table), t.write_mode, once=ledger, name=t.name)
        counts = res.file_stats.agg(
            F.count(F.lit(1)).alias("files"), F.count_if("is_invalid").alias("bad")
        ).first()
        run = TableRun(t.name, ts, loaded, counts["files"], counts["bad"])
        if ledger is not None:
            ledger.note(f"{t.name}-done", json.dumps({k: v for k, v in asdict(run).items() if k != "repeated"}))
        return run
    except Exception as e:  # one table's failure does not stop the others
        log.exception("table %s failed", t.name)
        return TableRun(t.name, ts, error=f"{type(e).__name__}: {e}")
    finally:
        if res is not None:
            res.release()
        spark.sparkContext.setJobDescription(None)
