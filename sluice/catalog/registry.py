"""Registered driver queries and their DuckDB oracle SQL."""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.rowchecks import normalise
from ..plans.validate import check_records, materialize
from ..schemas import CODE_KEY, CODE_NULL, CODE_PARSE
from . import oracle
from .datasets import DATASET, DATASETS, INGEST_TS, PIPELINE, UNDECLARED_PARSED_SQL

REPORT = [
    "source_filename", "index", "invalid_reason", "invalid_code", "invalid_col_name", "invalid_col_value",
]

Query = Callable[[SparkSession, str], DataFrame]


_OPEN: list = []


def _alone(check, *args, **options):
    """A query's frame is computed after the query has returned, so what it caches is dropped when
    the next one starts (before that caches anything: equal plans share one cache)."""
    while _OPEN:
        _OPEN.pop().release()
    _OPEN.append(check(*args, **options))
    return _OPEN[-1]


def _check(spark: SparkSession, sf: str, name: str):
    ds = DATASETS[name]
    return _alone(check_records,
        ds.spark_records(spark, sf), ds.rules, pipeline=PIPELINE, dataset=DATASET,
        table=name, ingest_ts=INGEST_TS,
        # one output per query: nothing to share, so nothing to materialize; the key sizes
        # read the key columns again, which costs less than a copy of all records;
        # table_records already spread a narrow table over the cores
        persist=False, cache_input=False, spread_rows=False,
    )


def _violations(name: str, code: str, cols: tuple[str, ...] = ()) -> tuple[Query, str]:
    def run(spark, sf):
        inv = _check(spark, sf, name).data_invalid.where(F.col("invalid_code") == code)
        if cols:
            inv = inv.where(F.col("invalid_col_name").isin(*cols))
        return inv.select(*REPORT)

    ds = DATASETS[name]
    where = f"c = {oracle.q(code)}"
    if cols:
        where += f" AND cn IN ({', '.join(oracle.q(c) for c in cols)})"
    sql = oracle.data_invalid_sql(
        ds.rules, ds.text_sql, INGEST_TS, PIPELINE, DATASET, name, where=where, columns=oracle.REPORT_COLS
    )
    return run, sql


def _not_loadable(name: str) -> tuple[Query, str]:
    ds = DATASETS[name]
    return (
        lambda spark, sf: _check(spark, sf, name).not_loadable.select(*REPORT),
        oracle.not_loadable_sql(ds.rules, ds.text_sql, INGEST_TS),
    )


def _data_invalid(name: str) -> tuple[Query, str]:
    ds = DATASETS[name]
    return (
        lambda spark, sf: _check(spark, sf, name).data_invalid,
        oracle.data_invalid_sql(ds.rules, ds.text_sql, INGEST_TS, PIPELINE, DATASET, name),
    )


def _rows_stats(name: str) -> tuple[Query, str]:
    ds = DATASETS[name]
    return (
        lambda spark, sf: _check(spark, sf, name).rows_stats,
        oracle.rows_stats_sql(ds.rules, ds.text_sql, INGEST_TS, PIPELINE, DATASET, name),
    )


def _valid(name: str) -> tuple[Query, str]:
    ds = DATASETS[name]
    return (
        lambda spark, sf: _check(spark, sf, name).valid,
        oracle.valid_sql(ds.rules, ds.text_sql, INGEST_TS),
    )


def _normalised(name: str, cols: list[str]) -> tuple[Query, str]:
    ds = DATASETS[name]

    def run(spark, sf):
        return normalise(ds.spark_records(spark, sf), ds.rules, INGEST_TS).select(*cols)

    return run, oracle.normalised_sql(ds.rules, ds.text_sql, INGEST_TS, [oracle.ident(c) for c in cols])


def _null_dates_pass_violations() -> tuple[Query, str]:
    """Date rules with nulls passing (rule option), orders."""
    import dataclasses

    ds = DATASETS["orders"]
    r = dataclasses.replace(ds.rules, null_dates_pass=True)

    def run(spark, sf):
        res = _alone(check_records,
            ds.spark_records(spark, sf), r, pipeline=PIPELINE, dataset=DATASET, table="orders",
            ingest_ts=INGEST_TS, persist=False, cache_input=False, spread_rows=False,
        )
        return res.data_invalid.where(F.col("invalid_code") == CODE_PARSE).select(*REPORT)

    where = f"c = {oracle.q(CODE_PARSE)}"
    return run, oracle.data_invalid_sql(
        r, ds.text_sql, INGEST_TS, PIPELINE, DATASET, "orders", where=where, columns=oracle.REPORT_COLS
    )


def _first_value_dates(kind: str) -> tuple[Query, str]:
    """Dates without a declared format, read by the format of their file's first value (X9)."""
    if kind == "violations":
        run = lambda spark, sf: _check(spark, sf, "undeclared").data_invalid.select(*REPORT)
        return run, UNDECLARED_PARSED_SQL + (
            "SELECT source_filename, \"index\", 'o_orderdate is not parsable to DATETIME' AS invalid_reason, 'COLUMN_NOT_PARSABLE' AS invalid_code, "
            "'o_orderdate' AS invalid_col_name, o_orderdate AS invalid_col_value FROM dated WHERE v IS NULL"
        )
    run = lambda spark, sf: _check(spark, sf, "undeclared").valid.select("source_filename", "o_orderkey", "o_orderdate")
    return run, UNDECLARED_PARSED_SQL + (
        "SELECT source_filename, CAST(o_orderkey AS BIGINT) AS o_orderkey, CASE WHEN o_orderdate IS NOT NULL THEN v END AS o_orderdate FROM dated WHERE v IS NOT NULL"
    )


def table_queries() -> dict[str, tuple[Query, str]]:
    return {
        # R1
        "required_violations": _violations("orders", CODE_NULL),
        # R2: single key, composite key, per-file scope, null keys
        "key_single_violations": _violations("part", CODE_KEY),
        "key_composite_violations": _violations("lineitem", CODE_KEY),
        "key_per_file_violations": _violations("documents", CODE_KEY),
        "key_null_violations": _violations("events", CODE_KEY),
        # R3b-R3d
        "float_parse_violations": _violations("orders", CODE_PARSE, ("o_totalprice",)),
        "integer_parse_violations": _violations("part", CODE_PARSE, ("p_size",)),
        "date_parse_violations": _violations("orders", CODE_PARSE, ("o_orderdate", "o_orderday")),
        "datetime_parse_violations": _violations("events", CODE_PARSE),
        "null_dates_pass_violations": _null_dates_pass_violations(),
        # X9: no declared format
        "date_first_value_violations": _first_value_dates("violations"),
        "date_first_value_valid": _first_value_dates("valid"),
        # R6: numbers that pass the check and no bigint holds
        "integer_not_loadable": _not_loadable("wide_keys"),
        # P1, P2
        "newline_normalised": _normalised("documents", ["source_filename", "index", "text"]),
        "drop_all_null": _normalised(
            "customer", ["source_filename", "index", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
        ),
        # R4 U1 U2 P9 (full report)
        "data_invalid_report": _data_invalid("orders"),
        "events_data_invalid": _data_invalid("events"),
        # A3-A6
        "rows_stats_report": _rows_stats("orders"),
        "documents_rows_stats": _rows_stats("documents"),
        "lineitem_rows_stats": _rows_stats("lineitem"),
        "customer_rows_stats": _rows_stats("customer"),
        # R5 R6
        "valid_typed": _valid("orders"),
        "lineitem_valid_typed": _valid("lineitem"),
        "customer_valid_typed": _valid("customer"),
        # R6: every digit of a long key
        "integer_exact_typed": _valid("wide_keys"),
    }


# ------------------------------------------------------------- landing ----
def _landing_check(spark, sf, **options):
    from .landing import orders_landing, orders_landing_rules
    from ..plans.landing import check_landing

    root = orders_landing(spark, sf)
    return _alone(check_landing,
        spark, root, orders_landing_rules(), pipeline=PIPELINE, dataset=DATASET, table="orders",
        ingest_ts=INGEST_TS, persist=False, **options,
    )


def _with_label(df: DataFrame) -> DataFrame:
    from .landing import label

    lab = F.when(label() != "", label()).otherwise(
        F.regexp_extract("source_filename", "orders_(region|wide)/", 1)
    )
    cols = [c for c in df.columns]
    return df.select(*[lab.alias("landing_file") if c == "source_filename" else F.col(c) for c in cols])


_ORDERS_LABEL = "k.source_filename AS landing_file"
_DQ = f"{oracle.q(PIPELINE)} AS pipeline, {oracle.q(DATASET)} AS dataset, 'orders' AS \"table\""
_TS_SQL = f"CAST({oracle.q(INGEST_TS)} AS TIMESTAMP) AS date_ingest"
_BAD_COLS = "'Columns do not respect the columns definition'"


def landing_queries() -> dict[str, tuple[Query, str]]:
    ds = DATASETS["orders"]
    ev = DATASETS["events"]
    from .landing import label
    from .datasets import DOCUMENTS_FILES_SQL, EVENTS_JSON_SQL, LINEITEM_FILES_SQL, ORDERS_FILES_SQL

    def file_stats(spark, sf):
        return _with_label(_landing_check(spark, sf).file_stats)

    def rows_stats(spark, sf):
        return _with_label(_landing_check(spark, sf).rows_stats)

    def data_invalid(spark, sf):
        return _with_label(_landing_check(spark, sf).data_invalid)

    def valid(spark, sf):
        return _with_label(_landing_check(spark, sf).valid)

    def sink_roundtrip(spark, sf):
        from ..session import new_scratch_path
        from ..sinks import load_valid, read_table

        res = _landing_check(spark, sf, materialize_as="stage")
        v = res.valid
        twice, trunc = new_scratch_path(spark, "sink-append"), new_scratch_path(spark, "sink-truncate")
        load_valid(v, twice, "APPEND")
        load_valid(v, twice, "APPEND")
        load_valid(v, trunc, "APPEND")
        load_valid(v, trunc, "TRUNCATE")
        res.release()
        a = _with_label(read_table(spark, twice)).groupBy("landing_file").agg(F.count(F.lit(1)).alias("rows_after_two_appends"))
        b = _with_label(read_table(spark, trunc)).groupBy("landing_file").agg(F.count(F.lit(1)).alias("rows_after_truncate"))
        return a.join(b, "landing_file", "full")

    def sink_failed_loads(spark, sf):
        """Rows a file after a TRUNCATE load that fails in one task, after an APPEND of another
        type, which is refused, and after a TRUNCATE load cut off while the table was away."""
        from .. import swap
        from ..session import new_scratch_path
        from ..sinks import SchemaMismatch, load_valid, read_table, write_table

        res = _landing_check(spark, sf, materialize_as="stage")
        v, path = res.valid, new_scratch_path(spark, "sink-failed")
        load_valid(v, path, "TRUNCATE")

        def rows(name):
            return _with_label(read_table(spark, path)).groupBy("landing_file").agg(F.count(F.lit(1)).alias(name))

        def fails(df, mode, error):
            try:
                write_table(df, path, mode)
            except error:
                return
            raise AssertionError(f"a load that must fail went through: {mode}")

        lost = F.when(F.col("o_orderstatus") == "P", F.raise_error(F.lit("a task is lost"))).otherwise(F.col("o_custkey"))
        fails(v.withColumn("o_custkey", lost), "TRUNCATE", Exception)
        first = materialize(rows("rows_after_failed_truncate"), "stage", "sink-counts")[0]
        fails(v.withColumn("o_totalprice", F.col("o_totalprice").cast("string")), "APPEND", SchemaMismatch)
        second = materialize(rows("rows_after_refused_append"), "stage", "sink-counts")[0]
        steps = swap.replace_steps(v.where("o_orderkey % 2 = 0"), path)
        while next(steps) != "old":  # the old rows have left their place, the new ones are not there yet
            pass
        steps.close()
        third = rows("rows_after_resumed_truncate")
        res.release()
        return first.join(second, "landing_file", "full").join(third, "landing_file", "full").fillna(0)

    def reports_roundtrip(spark, sf):
        """Reports appended twice (K2), valid rows loaded once and kept by an empty load (K4)."""
        from ..session import new_scratch_path
        from ..sinks import append_reports, load_valid, read_table

        res = _landing_check(spark, sf, materialize_as="stage")
        names = ("file_stats", "rows_stats", "data_invalid", "valid")
        paths = {n: new_scratch_path(spark, n) for n in names}
        for _ in range(2):
            append_reports(res, *[paths[n] for n in names[:3]])
        load_valid(res.valid, paths["valid"], "TRUNCATE")
        load_valid(res.valid.where(F.lit(False)), paths["valid"], "TRUNCATE")
        res.release()
        counts = [
            _with_label(read_table(spark, paths[n])).groupBy("landing_file")
            .agg(F.count(F.lit(1)).alias("n")).withColumn("report", F.lit(n))
            for n in names
        ]
        return reduce(DataFrame.unionByName, counts)

    def registry_run(spark, sf):
        """A registry (YAML) of two tables, one of them not requested, and the rule file (JSON) of the other: run
        twice under one name, so the reports and the valid rows are there once; the exported reports beside them."""
        from ..plans.run import run_landing
        from ..rules import RunConfig
        from ..session import new_scratch_path
        from ..sinks import EXPORT_OPTIONS, read_table
        from .landing import orders_landing, orders_landing_rules, write_registry

        root, out, export = orders_landing(spark, sf), new_scratch_path(spark, "registry"), new_scratch_path(spark, "registry-export")
        config = RunConfig.load(write_registry(orders_landing_rules()))
        for export_to in (export, None):
            runs = run_landing(spark, config, root, out, export_root=export_to, run_id="nightly")
            if [(r.name, r.error) for r in runs] != [("orders", None)]:
                raise AssertionError(f"the registry run failed: {runs}")
        paths = {n: f"{out}/data_quality/{n}" for n in ("file_stats", "rows_stats", "data_invalid")}
        frames = {**{n: read_table(spark, p) for n, p in paths.items()}, "valid": read_table(spark, f"{out}/raw/orders")}
        for n in paths:
            frames[f"exported {n}"] = spark.read.options(**EXPORT_OPTIONS).csv(f"{export}/data_quality/orders/{n}")
        counts = [
            _with_label(df.select("source_filename")).groupBy("landing_file").agg(F.count(F.lit(1)).alias("n")).withColumn("report", F.lit(n))
            for n, df in frames.items()
        ]
        return reduce(DataFrame.unionByName, counts)

    def export_roundtrip(spark, sf):
        """Exported valid rows as they stand in the CSV files, in the files' order."""
        from ..operators.rowchecks import typed_valid
        from ..session import new_scratch_path
        from ..sinks import EXPORT_OPTIONS, export_csv

        res, path = _check(spark, sf, "noted"), new_scratch_path(spark, "export")
        ordered = typed_valid(res.annotated, DATASETS["noted"].rules, extra=("_file", "_index"))
        export_csv(ordered, path, ["_file", "_index"], drop=["_file", "_index"])
        res.release()
        schema = "doc_id bigint, text string, note string, source_filename string, execution_datetime string"
        rows = spark.read.schema(schema).options(**EXPORT_OPTIONS).csv(path).select(
            "*", F.struct("_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("_at")
        )
        in_file = Window.partitionBy("source_filename").orderBy("_at")  # files of 10,000 keys at most
        return rows.select(
            "source_filename", "doc_id", "text", "note", (F.row_number().over(in_file) - 1).alias("place")
        )

    def lineitem_rows_stats(spark, sf):
        from .landing import lineitem_landing, lineitem_landing_rules
        from ..plans.landing import check_landing

        root = lineitem_landing(spark, sf)
        res = _alone(check_landing,
            spark, root, lineitem_landing_rules(), pipeline=PIPELINE, dataset=DATASET,
            table="lineitem", ingest_ts=INGEST_TS, persist=False, multi_line=False,
        )
        return res.rows_stats.withColumn("source_filename", label()).withColumnRenamed(
            "source_filename", "landing_file"
        )

    def hidden_file_stats(spark, sf):
        """Every file under the prefix has its row, also those whose names Spark's sources leave out."""
        from .landing import hidden_landing, hidden_landing_rules
        from ..plans.landing import check_landing

        res = _alone(check_landing,
            spark, hidden_landing(spark, sf), hidden_landing_rules(), pipeline=PIPELINE, dataset=DATASET, table="nation",
            ingest_ts=INGEST_TS, persist=False,
        )
        kept = F.instr("source_filename", "/_kept/") > 0
        return res.file_stats.withColumn("landing_file", F.concat(F.when(kept, "kept ").otherwise(""), label())).select("landing_file", "is_invalid", "description")

    def documents_check(spark, sf):
        """Files whose texts hold newlines, read by blocks like any others."""
        from .landing import documents_landing, documents_landing_rules
        from ..plans.landing import check_landing

        root = documents_landing(spark, sf)
        return _alone(check_landing,
            spark, root, documents_landing_rules(), pipeline=PIPELINE, dataset=DATASET, table="documents",
            ingest_ts=INGEST_TS, persist=False,
        )

    def documents_rows_stats(spark, sf):
        return documents_check(spark, sf).rows_stats.withColumn("source_filename", label()).withColumnRenamed("source_filename", "landing_file")

    def documents_invalid(spark, sf):
        return documents_check(spark, sf).data_invalid.withColumn("source_filename", label()).withColumnRenamed("source_filename", "landing_file")

    def documents_valid(spark, sf):
        return documents_check(spark, sf).valid.withColumn("source_filename", label()).withColumnRenamed("source_filename", "landing_file")

    def json_check(spark, sf, **options):
        from .landing import events_json_landing, events_json_rules
        from ..plans.landing import check_landing

        root = events_json_landing(spark, sf)
        res = _alone(check_landing,
            spark, root, events_json_rules(), pipeline=PIPELINE, dataset=DATASET, table="events",
            ingest_ts=INGEST_TS, persist=False, **options,
        )
        return lambda df: df.withColumn("source_filename", label()).withColumnRenamed("source_filename", "landing_file"), res

    def json_rows_stats(spark, sf):
        labelled, res = json_check(spark, sf)
        return labelled(res.rows_stats)

    def json_file_stats(spark, sf):
        labelled, res = json_check(spark, sf)
        return labelled(res.file_stats)

    def json_data_invalid(spark, sf):
        labelled, res = json_check(spark, sf)
        return labelled(res.data_invalid)

    def json_split_file_stats(spark, sf):
        """Every JSON file read by blocks, whatever its size."""
        labelled, res = json_check(spark, sf, json_split_bytes=0)
        return labelled(res.file_stats)

    def json_split_data_invalid(spark, sf):
        """Members of the arrays numbered by blocks; every file is split."""
        labelled, res = json_check(spark, sf, json_split_bytes=0)
        return labelled(res.data_invalid)

    file_stats_sql = (
        f"SELECT {_DQ}, landing_file, {_TS_SQL}, is_invalid, description FROM ("
        "SELECT DISTINCT o_orderstatus || '_' || CAST(o_orderkey // 1000000 AS VARCHAR) AS landing_file, false AS is_invalid, 'File is VALID' AS description FROM orders "
        f"UNION ALL SELECT DISTINCT c_mktsegment || '_' || CAST(c_custkey // 1000000 AS VARCHAR), true, {_BAD_COLS} FROM customer "
        f"UNION ALL SELECT DISTINCT 'region', true, {_BAD_COLS} FROM region "
        "UNION ALL SELECT DISTINCT 'wide', true, 'Error when reading the CSV file : "
        "Error tokenizing data. Expected 7 fields, saw 8' FROM nation)"
    )
    json_file_stats_sql = (
        f"SELECT {_DQ.replace("'orders'", "'events'")}, landing_file, {_TS_SQL}, is_invalid, description FROM ("
        "SELECT DISTINCT strftime(ts, '%Y-%m-%d') || '_' || CAST(event_id // 1000 AS VARCHAR) AS landing_file, "
        "false AS is_invalid, 'File is VALID' AS description FROM events "
        "UNION ALL SELECT r_name, true, 'Error when reading the JSON file : "
        "document is not a JSON array of objects' FROM region)"
    )
    valid_label = {"source_filename": "source_filename AS landing_file"}
    valid_sql = oracle.valid_sql(ds.rules, ORDERS_FILES_SQL, INGEST_TS, replace=valid_label)
    sink_sql = (
        f"SELECT landing_file, count(*) * 2 AS rows_after_two_appends, count(*) AS rows_after_truncate "
        f"FROM ({valid_sql}) GROUP BY landing_file"
    )
    failed_sql = (
        "SELECT landing_file, count(*) AS rows_after_failed_truncate, count(*) AS rows_after_refused_append, "
        f"count(*) FILTER (WHERE o_orderkey % 2 = 0) AS rows_after_resumed_truncate FROM ({valid_sql}) GROUP BY landing_file"
    )
    rows_stats_sql = oracle.rows_stats_sql(
        ds.rules, ORDERS_FILES_SQL, INGEST_TS, PIPELINE, DATASET, "orders", file_col=_ORDERS_LABEL
    )
    data_invalid_sql = oracle.data_invalid_sql(
        ds.rules, ORDERS_FILES_SQL, INGEST_TS, PIPELINE, DATASET, "orders",
        columns=[
            _DQ, "source_filename AS landing_file", '"index"',
            "r AS invalid_reason", "c AS invalid_code", "cn AS invalid_col_name",
            "cv AS invalid_col_value", _TS_SQL,
        ],
    )
    reports_sql = " UNION ALL ".join(
        f"SELECT landing_file, {times} * count(*) AS n, {oracle.q(name)} AS report FROM ({sql}) GROUP BY landing_file"
        for name, times, sql in (
            ("file_stats", 2, file_stats_sql), ("rows_stats", 2, rows_stats_sql),
            ("data_invalid", 2, data_invalid_sql), ("valid", 1, valid_sql),
        )
    )
    unread = "'Error when reading the file : names that begin with _ or . are not read'"
    hidden_sql = (
        f"SELECT DISTINCT CAST(n_regionkey AS VARCHAR) AS landing_file, n_regionkey % 3 > 0 AS is_invalid, "
        f"CASE WHEN n_regionkey % 3 > 0 THEN {unread} ELSE 'File is VALID' END AS description FROM nation "
        f"UNION ALL SELECT 'kept ' || CAST(r_regionkey AS VARCHAR), true, {unread} FROM region"
    )
    registry_sql = " UNION ALL ".join(
        f"SELECT landing_file, count(*) AS n, {oracle.q(name)} AS report FROM ({sql}) GROUP BY landing_file"
        for name, sql in (
            ("file_stats", file_stats_sql), ("rows_stats", rows_stats_sql), ("data_invalid", data_invalid_sql), ("valid", valid_sql),
            ("exported file_stats", file_stats_sql), ("exported rows_stats", rows_stats_sql), ("exported data_invalid", data_invalid_sql),
        )
    )
    docs = DATASETS["documents"]
    docs_dq = _DQ.replace("'orders'", "'documents'")
    documents_invalid_sql = oracle.data_invalid_sql(
        docs.rules, DOCUMENTS_FILES_SQL, INGEST_TS, PIPELINE, DATASET, "documents",
        columns=[
            docs_dq, "source_filename AS landing_file", '"index"', "r AS invalid_reason", "c AS invalid_code",
            "cn AS invalid_col_name", "cv AS invalid_col_value", _TS_SQL,
        ],
    )
    documents_stats_sql = oracle.rows_stats_sql(
        docs.rules, DOCUMENTS_FILES_SQL, INGEST_TS, PIPELINE, DATASET, "documents", file_col=_ORDERS_LABEL
    )
    json_invalid_sql = oracle.data_invalid_sql(
        ev.rules, EVENTS_JSON_SQL, INGEST_TS, PIPELINE, DATASET, "events",
        columns=[
            _DQ.replace("'orders'", "'events'"), "source_filename AS landing_file", '"index"',
            "r AS invalid_reason", "c AS invalid_code", "cn AS invalid_col_name",
            "cv AS invalid_col_value", _TS_SQL,
        ],
    )
    noted = DATASETS["noted"]
    export_sql = (
        "SELECT source_filename, doc_id, text, note, "
        "row_number() OVER (PARTITION BY source_filename ORDER BY doc_id) - 1 AS place "
        f"FROM ({oracle.valid_sql(noted.rules, noted.text_sql, INGEST_TS)})"
    )
    return {
        "landing_file_stats": (file_stats, file_stats_sql),
        "reports_roundtrip": (reports_roundtrip, reports_sql),
        "export_roundtrip": (export_roundtrip, export_sql),
        "json_landing_file_stats": (json_file_stats, json_file_stats_sql),
        "landing_rows_stats": (rows_stats, rows_stats_sql),
        "landing_data_invalid": (data_invalid, data_invalid_sql),
        "landing_valid_typed": (valid, valid_sql),
        "sink_roundtrip": (sink_roundtrip, sink_sql),
        "sink_failed_loads": (sink_failed_loads, failed_sql),
        "landing_lineitem_rows_stats": (
            lineitem_rows_stats,
            oracle.rows_stats_sql(
                DATASETS["lineitem"].rules, LINEITEM_FILES_SQL, INGEST_TS, PIPELINE, DATASET,
                "lineitem", file_col="k.source_filename AS landing_file",
            ),
        ),
        "registry_run": (registry_run, registry_sql),
        "hidden_file_stats": (hidden_file_stats, hidden_sql),
        "landing_documents_rows_stats": (documents_rows_stats, documents_stats_sql),
        "landing_documents_data_invalid": (documents_invalid, documents_invalid_sql),
        "landing_documents_valid": (documents_valid, oracle.valid_sql(docs.rules, DOCUMENTS_FILES_SQL, INGEST_TS, replace=valid_label)),
        "json_landing_data_invalid": (json_data_invalid, json_invalid_sql),
        "json_split_file_stats": (json_split_file_stats, json_file_stats_sql),
        "json_split_data_invalid": (json_split_data_invalid, json_invalid_sql),
        "json_landing_rows_stats": (
            json_rows_stats,
            oracle.rows_stats_sql(
                ev.rules, EVENTS_JSON_SQL, INGEST_TS, PIPELINE, DATASET, "events",
                file_col="k.source_filename AS landing_file",
            ),
        ),
    }


def all_queries() -> dict[str, tuple[Query, str]]:
    return {**table_queries(), **landing_queries()}
