"""Landing plan: list -> scan -> file checks -> row checks, all files at once."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filechecks import file_stats
from ..rules import PIPELINE_NAME, TableRules
from ..session import broadcast_budget
from ..sources.csv import BLOCK_BYTES, FILE_BYTES, SEEDS, scan_csv, scan_csv_files
from ..sources.json import SPLIT_BYTES, scan_json_files
from ..sources.listing import FILE_ID, PATH, list_files
from .validate import CheckResult, check_records, now_utc

WORKBOOK_EXTS = ("xlsx", "xlsm")
SKEW_FACTOR = 4
#: Bytes of landing files whose parsed records are cached; more would take executor memory and disks of their size.
CACHE_BYTES = 8 * 1024**3


def _listed(spark: SparkSession, root: str, rules: TableRules, paths: list[str] | None):
    """Cached listing, {extension: files, bytes, biggest}, and the seed under
    which all file keys differ (the first one, but for a 64-bit collision)."""
    for seed in SEEDS:
        listing = list_files(spark, root, rules.source_path, paths, seed).persist(StorageLevel.MEMORY_AND_DISK)
        keys = listing.groupBy(FILE_ID).agg(
            F.count(F.lit(1)).alias("n"), F.min("ext").alias("ext"), F.max("length").alias("length")
        )
        # Formats present decide which scans run (a handful of distinct values).
        formats = {
            r["ext"]: r.asDict()
            for r in keys.groupBy("ext").agg(
                F.sum("n").alias("files"), F.max("n").alias("most"),
                F.sum("length").alias("bytes"), F.max("length").alias("biggest"),
            ).collect()
        }
        if all(f["most"] == 1 for f in formats.values()):
            return listing, formats, seed
        listing.unpersist()
    raise RuntimeError("the listing names a file twice")


def skewed_blocks(blocks: DataFrame, parallelism: int) -> bool:
    """True when one scan block holds several times a fair share of the rows
    (read from the small cached block table)."""
    biggest, total = blocks.agg(F.max("_n"), F.sum("_n")).first()
    return bool(total) and biggest > SKEW_FACTOR * total / parallelism


def check_landing(
    spark: SparkSession,
    root: str,
    rules: TableRules,
    *,
    pipeline: str = PIPELINE_NAME,
    dataset: str = "raw",
    table: str = "table",
    ingest_ts: str | None = None,
    multi_line: bool | None = None,
    persist: bool = True,
    paths: list[str] | None = None,
    materialize_as: str | None = None,
    cache_scan: bool | None = None,
    json_split_bytes: int = SPLIT_BYTES,
) -> CheckResult:
    """Check every landing file of one table: returns the four outputs.

    UTF-8 CSV files are split into blocks, also where values hold quoted newlines
    (``scan_csv_files``); ``multi_line`` forces one mode on all:
    True reads record by record (one task a file), False by lines (a quoted
    newline then makes its file unreadable). ``paths`` restricts the run
    to the given landing files (incremental runs); by default every file
    under the table's prefix is checked. ``cache_scan`` False parses the CSV
    and JSON files anew for each step (block table, key sizes, checks) instead
    of caching the parsed records; by default files of up to CACHE_BYTES
    together are cached, but for CSV files read by lines, which are only cached if it is True. JSON files beyond
    ``json_split_bytes`` are read by many tasks each.
    """
    ts = ingest_ts or now_utc()
    paths = list(dict.fromkeys(paths)) if paths else None
    listing, formats, seed = _listed(spark, root, rules, paths)
    cached: list[DataFrame] = [listing]
    nfiles = sum(f["files"] for f in formats.values())
    # Lines are cut anew for each step: each needs few of their columns, and a copy of all costs more to make.
    cache_lines = bool(cache_scan)
    if cache_scan is None:
        cache_scan = sum(f["bytes"] for f in formats.values()) <= CACHE_BYTES
    small = nfiles * FILE_BYTES <= broadcast_budget(spark)
    parallelism = spark.sparkContext.defaultParallelism
    # Checks are CPU work per row. A scan with a block far beyond its fair share
    # (a large file that one task must read) deals its own rows out again.
    parts, rows, csv_facts, json_facts, wb_facts = 0, [], None, None, None
    if "csv" in formats:
        if multi_line is None:
            scans = scan_csv_files(spark, root, rules, paths, cache_scan, seed, cache_lines)
        else:
            scans = [scan_csv(spark, root, rules, multi_line=multi_line, paths=paths, cache_scan=cache_scan if multi_line else cache_lines, seed=seed)]
        for scan in scans:
            uneven = skewed_blocks(scan.blocks, parallelism)
            rows.append(scan.rows.repartition(parallelism) if uneven else scan.rows)
            csv_facts = scan.facts if csv_facts is None else csv_facts.unionByName(scan.facts)
            cached += scan.cached
            parts += parallelism if uneven else scan.nblocks
    if "json" in formats:
        f = formats["json"]
        scans = scan_json_files(spark, root, rules, paths, f["biggest"], cache_scan=cache_scan, seed=seed, split_bytes=json_split_bytes)
        # a file that is split is no task's own; those that are not are below the split size
        uneven = len(scans) == 1 and f["biggest"] > SKEW_FACTOR * f["bytes"] / parallelism
        for scan in scans:
            rows.append(scan.rows.repartition(parallelism) if uneven else scan.rows)
            json_facts = scan.facts if json_facts is None else json_facts.unionByName(scan.facts)
            cached += scan.cached
        parts += parallelism if uneven else f["files"] + f["bytes"] // max(1, json_split_bytes)
    if set(formats) & set(WORKBOOK_EXTS):
        from ..sources.workbook import scan_workbooks

        scan = scan_workbooks(spark, root, rules, paths, seed=seed)
        rows.append(scan.rows)
        wb_facts = scan.facts
        cached += scan.cached
        parts += sum(formats[e]["files"] for e in WORKBOOK_EXTS if e in formats)
    fstats = file_stats(
        listing, csv_facts, json_facts, wb_facts, pipeline, dataset, table, ts, small=small,
    )
    fstats = fstats.persist(StorageLevel.MEMORY_AND_DISK)
    cached.append(fstats)
    # One row per listed file; names and ids of the valid ones.
    valid_files = fstats.where(~F.col("is_invalid")).select(PATH, "source_filename")
    if rows:
        # rows of invalid files go nowhere (semi-join on the 64-bit file key).
        ids = valid_files.join(listing.select(PATH, FILE_ID), PATH).select(FILE_ID)
        ids = F.broadcast(ids) if nfiles * BLOCK_BYTES <= broadcast_budget(spark) else ids
        records = reduce(DataFrame.unionByName, rows).join(ids, FILE_ID, "left_semi")
    else:
        schema = "source_filename string, index bigint, " + ", ".join(
            f"`{c.name}` string" for c in rules.data_columns
        )
        records = spark.createDataFrame([], schema)
    result = check_records(
        records, rules, pipeline=pipeline, dataset=dataset, table=table, ingest_ts=ts,
        spread_rows=0 < parts < parallelism,  # fewer scan tasks than task slots
        files=valid_files.select("source_filename"), persist=persist,
        files_small=nfiles * 256 <= broadcast_budget(spark),
        cache_input=False,  # the scan below the records is cached already
        materialize_as=materialize_as,
    )
    result.file_stats = fstats.drop(PATH)
    result.cached = cached + result.cached
    if materialize_as == "stage":
        # The annotated rows are on shared storage: the scan cache is no
        # longer needed by the row outputs (file_stats is small and cached).
        for df in cached:
            if df is not fstats and df is not listing and "unpersist" not in vars(df):  # staged tables stay until the release
                df.unpersist()
    return result
