"""Incremental landing: check each new landing file once, as files arrive.

A Structured Streaming file source over the table's prefix (``binaryFile``,
path only, content not read) yields the files not seen before; each
micro-batch runs the same batch checks on exactly those files. All checks are
scoped to one file, so no state is carried between batches; the stream's
checkpoint (in the shared checkpoint folder) records which files are done.

Writes are idempotent per micro-batch: every output goes to a
``_query=<stream>/_batch_id=<id>`` partition that a replayed batch overwrites, so a
restart after a failure does not duplicate rows. ``file_stats`` is written last and
is the ledger of files: those that have a row there are done, also for a stream
that starts anew with a fresh checkpoint, which neither doubles nor overwrites
what an earlier one wrote. Only APPEND tables can be fed this way (TRUNCATE would
keep only the last batch).
"""

from __future__ import annotations

import os
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.landing import check_landing
from ..plans.run import target
from ..plans.validate import now_utc
from ..rules import RunConfig, TableConfig, TableRules
from ..schemas import DATA_INVALID, FILE_STATS, ROWS_STATS
from ..sinks import conform
from ..sources.listing import prefix_glob, relative_name

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def default_checkpoint(spark: SparkSession, table: TableConfig) -> str:
    """Stream state must outlive the application: it goes under the configured
    spark.checkpoint.dir itself, not the per-application subfolder Spark
    creates there for RDD checkpoints."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("pass checkpoint= or set spark.checkpoint.dir (a shared folder)")
    return os.path.join(base, "sluice-streams", table.dataset, table.table)


def _write_batch(df: DataFrame, path: str, batch_id: int, table: TableConfig | None = None, query: str = "0") -> None:
    """One folder per stream and batch, and per table where tables share the target."""
    own = f"/_stream={quote(f'{table.dataset}.{table.table}', safe='')}" if table else ""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}{own}/_query={query}/_batch_id={batch_id}")


def _done(spark: SparkSession, path: str, table: TableConfig) -> DataFrame | None:
    """Names of the files that have a file_stats row from this table's streams."""
    own = f"{path.rstrip('/')}/_stream={quote(f'{table.dataset}.{table.table}', safe='')}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.schema(FILE_STATS).option("recursiveFileLookup", "true").parquet(own).select(F.col("source_filename").alias("d_name"))


def table_stream(
    spark: SparkSession,
    table: TableConfig,
    landing_root: str,
    output_root: str,
    config: RunConfig | None = None,
    checkpoint: str | None = None,
    max_files_per_trigger: int = 1000,
    available_now: bool = True,
    multi_line: bool | None = None,
    **check_options,
) -> StreamingQuery:
    """Start the incremental check of one table. ``available_now`` processes
    what has landed and stops (run it on a schedule); otherwise it keeps
    watching the prefix."""
    if table.write_mode != "APPEND":
        raise ValueError(f"table {table.name}: incremental loads need write_mode APPEND")
    config = config or RunConfig(tables=(table,))
    rules = TableRules.load(table.rules_file)
    checkpoint = checkpoint or default_checkpoint(spark, table)
    quality = {
        "file_stats": target(output_root, config.quality_dataset, config.file_stats_table),
        "rows_stats": target(output_root, config.quality_dataset, config.rows_stats_table),
        "data_invalid": target(output_root, config.quality_dataset, config.data_invalid_table),
    }
    valid_target = target(output_root, table.dataset, table.table)

    def process(batch: DataFrame, batch_id: int) -> None:
        # The batch lists file paths only (at most max_files_per_trigger).
        new, done = batch.select("path"), _done(spark, quality["file_stats"], table)
        if done is not None:
            new = new.join(done, relative_name(F.col("path"), landing_root) == F.col("d_name"), "left_anti")
        paths = [r.path for r in new.collect()]
        if not paths:
            return
        # a fresh checkpoint gives the stream another id
        query = (spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "0")[:8]
        res = check_landing(
            spark, landing_root, rules, pipeline=config.pipeline_name, dataset=table.dataset,
            table=table.table, ingest_ts=now_utc(), multi_line=multi_line, paths=paths,
            **check_options,
        )
        try:
            if not res.valid.isEmpty():
                _write_batch(res.valid, valid_target, batch_id, query=query)
            _write_batch(conform(res.rows_stats, ROWS_STATS), quality["rows_stats"], batch_id, table, query)
            _write_batch(conform(res.data_invalid, DATA_INVALID), quality["data_invalid"], batch_id, table, query)
            _write_batch(conform(res.file_stats, FILE_STATS), quality["file_stats"], batch_id, table, query)
        finally:
            res.release()

    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(prefix_glob(landing_root, rules.source_path))
        .select("path")
    )
    writer = files.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
