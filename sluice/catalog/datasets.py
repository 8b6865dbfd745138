"""Driver tables as landing text, written twice: Spark Columns and DuckDB SQL.

Defects are added deterministically from the row key (the driver tables have
no nulls and no bad values); every row of every table is kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules import ColumnRule, PIPELINE_NAME, TableRules
from ..sources.tables import table_records
from .oracle import ident, na_null

INGEST_TS = "2024-01-01 00:00:00"
PIPELINE = PIPELINE_NAME
DATASET = "raw"


def lineage() -> tuple[ColumnRule, ColumnRule]:
    return (
        ColumnRule("source_filename", "STRING"),
        ColumnRule("execution_datetime", "DATETIME"),
    )


def col(name, type_="STRING", mode="NULLABLE", key=False, fmt=None, th=None, dec=None, header=None):
    return ColumnRule(
        name=name, type=type_, expected_file_name=header or name, mode=mode,
        unique_identifier=key, date_format=fmt, float_thousand_separator=th,
        float_decimal_separator=dec,
    )


def rules_of(*cols: ColumnRule, **kw) -> TableRules:
    return TableRules(columns=(*cols, *lineage()), **kw)


@dataclass(frozen=True)
class Dataset:
    name: str
    rules: TableRules
    spark_records: Callable[[SparkSession, str], DataFrame]
    text_sql: str


def _text_sql(file_sql: str, index_sql: str, cols: dict[str, str], source: str) -> str:
    body = ", ".join(f"{na_null(expr)} AS {ident(name)}" for name, expr in cols.items())
    return f"SELECT {file_sql} AS source_filename, {index_sql} AS \"index\", {body} FROM {source}"


def _s(c: Column) -> Column:
    return c.cast("string")


# ---------------------------------------------------------------- orders ----
ORDERS = rules_of(
    col("o_orderkey", "INTEGER", "REQUIRED", key=True),
    col("o_custkey", "INTEGER"),
    col("o_orderstatus", "STRING", "REQUIRED"),
    col("o_totalprice", "FLOAT", th=".", dec=","),
    col("o_orderdate", "DATE", fmt="%d/%m/%Y"),
    col("o_orderday", "DATE", fmt="%d %B %Y"),
    col("o_orderpriority", "STRING", "REQUIRED"),
)


def _orders_spark(spark: SparkSession, sf: str) -> DataFrame:
    o = spark.read.parquet(f"{sf}/orders.parquet")
    k = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    euro = F.concat(
        F.replace(F.format_number(F.floor(cents / F.lit(100)), 0), F.lit(","), F.lit(".")),
        F.lit(","),
        F.lpad(_s(cents % 100), 2, "0"),
    )
    d = F.col("o_orderdate")
    year = F.date_format(d, "yyyy")
    texts = {
        "o_orderkey": _s(F.when(k % 101 == 0, k - 1).otherwise(k)),
        "o_custkey": F.when(k % 13 == 0, F.concat(_s(F.col("o_custkey")), F.lit(".5")))
        .when(k % 17 == 0, F.concat(_s(F.col("o_custkey")), F.lit(".0")))
        .otherwise(_s(F.col("o_custkey"))),
        "o_totalprice": F.when(k % 19 == 0, F.lit(None))
        .when(k % 23 == 0, F.concat(euro, F.lit("x")))
        .otherwise(euro),
        "o_orderdate": F.when(k % 29 == 0, F.concat(F.lit("31/02/"), year))
        .when(k % 31 == 0, F.lit(None))
        .otherwise(F.date_format(d, "dd/MM/yyyy")),
        "o_orderday": F.when(k % 41 == 0, F.upper(F.date_format(d, "d MMMM yyyy")))
        .when(k % 43 == 0, F.concat(F.lit("30 February "), year))
        .when(k % 47 == 0, F.lit(None))
        .otherwise(F.date_format(d, "d MMMM yyyy")),
        "o_orderpriority": F.when(k % 37 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")),
    }
    return table_records(
        o, ORDERS, F.concat(F.lit("orders/"), F.col("o_orderstatus"), F.lit(".csv")), k, texts
    )


_EURO = (
    "replace(format('{:,}', CAST(round(o_totalprice * 100) AS BIGINT) // 100), ',', '.') || ',' || "
    "lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0')"
)
ORDERS_SQL = _text_sql(
    "'orders/' || o_orderstatus || '.csv'",
    "o_orderkey",
    {
        "o_orderkey": "CAST(CASE WHEN o_orderkey % 101 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS VARCHAR)",
        "o_custkey": "CASE WHEN o_orderkey % 13 = 0 THEN CAST(o_custkey AS VARCHAR) || '.5' "
        "WHEN o_orderkey % 17 = 0 THEN CAST(o_custkey AS VARCHAR) || '.0' ELSE CAST(o_custkey AS VARCHAR) END",
        "o_orderstatus": "o_orderstatus",
        "o_totalprice": f"CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN {_EURO} || 'x' ELSE {_EURO} END",
        "o_orderdate": "CASE WHEN o_orderkey % 29 = 0 THEN '31/02/' || strftime(o_orderdate, '%Y') "
        "WHEN o_orderkey % 31 = 0 THEN NULL ELSE strftime(o_orderdate, '%d/%m/%Y') END",
        "o_orderday": "CASE WHEN o_orderkey % 41 = 0 THEN upper(strftime(o_orderdate, '%-d %B %Y')) "
        "WHEN o_orderkey % 43 = 0 THEN '30 February ' || strftime(o_orderdate, '%Y') "
        "WHEN o_orderkey % 47 = 0 THEN NULL ELSE strftime(o_orderdate, '%-d %B %Y') END",
        "o_orderpriority": "CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE o_orderpriority END",
    },
    "orders",
)

# ------------------------------------------------------------------ part ----
PART = rules_of(
    col("p_partkey", "INTEGER", "REQUIRED"),
    col("p_name", "STRING", "REQUIRED", key=True),
    col("p_size", "INTEGER"),
    col("p_retailprice", "FLOAT"),
)


def _part_spark(spark: SparkSession, sf: str) -> DataFrame:
    p = spark.read.parquet(f"{sf}/part.parquet")
    k = F.col("p_partkey")
    size = _s(F.col("p_size"))
    texts = {
        "p_size": F.when(k % 7 == 0, F.concat(size, F.lit(".05")))
        .when(k % 7 == 1, F.concat(size, F.lit(".5")))
        .when(k % 7 == 2, F.concat(size, F.lit(",0")))
        .when(k % 7 == 3, F.concat(size, F.lit(".0")))
        .otherwise(size),
        "p_retailprice": _s(F.col("p_retailprice").cast("decimal(12,2)")),
    }
    return table_records(p, PART, F.concat(F.lit("part/"), F.col("p_brand"), F.lit(".csv")), k, texts)


PART_SQL = _text_sql(
    "'part/' || p_brand || '.csv'",
    "p_partkey",
    {
        "p_partkey": "CAST(p_partkey AS VARCHAR)",
        "p_name": "p_name",
        "p_size": "CASE WHEN p_partkey % 7 = 0 THEN CAST(p_size AS VARCHAR) || '.05' "
        "WHEN p_partkey % 7 = 1 THEN CAST(p_size AS VARCHAR) || '.5' "
        "WHEN p_partkey % 7 = 2 THEN CAST(p_size AS VARCHAR) || ',0' "
        "WHEN p_partkey % 7 = 3 THEN CAST(p_size AS VARCHAR) || '.0' ELSE CAST(p_size AS VARCHAR) END",
        "p_retailprice": "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR)",
    },
    "part",
)

# -------------------------------------------------------------- lineitem ----
LINEITEM = rules_of(
    col("l_orderkey", "INTEGER", "REQUIRED", key=True),
    col("l_linenumber", "INTEGER", "REQUIRED", key=True),
    col("l_partkey", "INTEGER", "REQUIRED"),
    col("l_quantity", "FLOAT"),
    col("l_extendedprice", "FLOAT"),
    col("l_returnflag", "STRING", "REQUIRED"),
    col("l_shipdate", "DATE", fmt="%Y-%m-%d"),
)


def _lineitem_spark(spark: SparkSession, sf: str) -> DataFrame:
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    texts = {
        "l_quantity": _s(F.col("l_quantity").cast("decimal(12,2)")),
        "l_extendedprice": _s(F.col("l_extendedprice").cast("decimal(14,2)")),
        "l_shipdate": F.date_format(F.col("l_shipdate"), "yyyy-MM-dd"),
    }
    index = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return table_records(li, LINEITEM, F.lit("lineitem/lineitem.csv"), index, texts)


LINEITEM_SQL = _text_sql(
    "'lineitem/lineitem.csv'",
    "l_orderkey * 10 + l_linenumber",
    {
        "l_orderkey": "CAST(l_orderkey AS VARCHAR)",
        "l_linenumber": "CAST(l_linenumber AS VARCHAR)",
        "l_partkey": "CAST(l_partkey AS VARCHAR)",
        "l_quantity": "CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR)",
        "l_extendedprice": "CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR)",
        "l_returnflag": "l_returnflag",
        "l_shipdate": "strftime(l_shipdate, '%Y-%m-%d')",
    },
    "lineitem",
)

# ------------------------------------------------------------- documents ----
DOCUMENTS = rules_of(
    col("doc_id", "INTEGER", "REQUIRED"),
    col("text", "STRING", "REQUIRED", key=True),
    col("lang", "STRING", "REQUIRED"),
    col("n_chars", "INTEGER"),
)


def _documents_spark(spark: SparkSession, sf: str) -> DataFrame:
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return table_records(d, DOCUMENTS, F.col("source"), F.col("doc_id"))


DOCUMENTS_SQL = _text_sql(
    "source",
    "doc_id",
    {
        "doc_id": "CAST(doc_id AS VARCHAR)",
        "text": "text",
        "lang": "lang",
        "n_chars": "CAST(n_chars AS VARCHAR)",
    },
    "documents",
)

# -------------------------------------------------------------- customer ----
CUSTOMER = rules_of(
    col("c_name", "STRING", "REQUIRED"),
    col("c_nationkey", "INTEGER"),
    col("c_acctbal", "FLOAT"),
    col("c_mktsegment", "STRING"),
)


def _customer_spark(spark: SparkSession, sf: str) -> DataFrame:
    c = spark.read.parquet(f"{sf}/customer.parquet")
    blank = F.col("c_custkey") % 10 == 0
    texts = {
        "c_name": F.when(~blank, F.col("c_name")),
        "c_nationkey": F.when(~blank, _s(F.col("c_nationkey"))),
        "c_acctbal": F.when(~blank, _s(F.col("c_acctbal").cast("decimal(12,2)"))),
        "c_mktsegment": F.when(~blank, F.col("c_mktsegment")),
    }
    return table_records(
        c, CUSTOMER, F.concat(F.lit("customer/"), F.col("c_mktsegment"), F.lit(".csv")),
        F.col("c_custkey"), texts,
    )


CUSTOMER_SQL = _text_sql(
    "'customer/' || c_mktsegment || '.csv'",
    "c_custkey",
    {
        "c_name": "CASE WHEN c_custkey % 10 <> 0 THEN c_name END",
        "c_nationkey": "CASE WHEN c_custkey % 10 <> 0 THEN CAST(c_nationkey AS VARCHAR) END",
        "c_acctbal": "CASE WHEN c_custkey % 10 <> 0 THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) END",
        "c_mktsegment": "CASE WHEN c_custkey % 10 <> 0 THEN c_mktsegment END",
    },
    "customer",
)

# ---------------------------------------------------------------- events ----
EVENTS = rules_of(
    col("event_id", "INTEGER", "REQUIRED"),
    col("ts", "DATETIME", fmt="%Y-%m-%d %H:%M:%S"),
    col("user_id", "INTEGER", key=True),
    col("event_type", "STRING", key=True),
    col("value", "FLOAT"),
    col("props", "STRING"),
)


def events_records(spark: SparkSession, sf: str, file: Column | None = None) -> DataFrame:
    """Events as landing text; ``file`` defaults to one pseudo file per day."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    k = F.col("event_id")
    iso = F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss")
    texts = {
        "ts": F.when(k % 53 == 0, F.replace(iso, F.lit(" "), F.lit("T")))
        .when(k % 59 == 0, F.lit(None))
        .otherwise(iso),
        "user_id": F.when(k % 7 != 0, _s(F.col("user_id"))),
        "event_type": F.when(k % 5 != 0, F.col("event_type")),
        "value": _s(F.col("value").cast("decimal(12,2)")),
    }
    if file is None:
        file = F.concat(F.lit("events/"), F.date_format(F.col("ts"), "yyyy-MM-dd"), F.lit(".csv"))
    return table_records(e, EVENTS, file, k, texts)


def _events_spark(spark: SparkSession, sf: str) -> DataFrame:
    return events_records(spark, sf)


EVENTS_SQL = _text_sql(
    "'events/' || strftime(ts, '%Y-%m-%d') || '.csv'",
    "event_id",
    {
        "event_id": "CAST(event_id AS VARCHAR)",
        "ts": "CASE WHEN event_id % 53 = 0 THEN replace(strftime(ts, '%Y-%m-%d %H:%M:%S'), ' ', 'T') "
        "WHEN event_id % 59 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END",
        "user_id": "CASE WHEN event_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END",
        "event_type": "CASE WHEN event_id % 5 <> 0 THEN event_type END",
        "value": "CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)",
        "props": "props",
    },
    "events",
)

DATASETS = {
    d.name: d
    for d in (
        Dataset("orders", ORDERS, _orders_spark, ORDERS_SQL),
        Dataset("part", PART, _part_spark, PART_SQL),
        Dataset("lineitem", LINEITEM, _lineitem_spark, LINEITEM_SQL),
        Dataset("documents", DOCUMENTS, _documents_spark, DOCUMENTS_SQL),
        Dataset("customer", CUSTOMER, _customer_spark, CUSTOMER_SQL),
        Dataset("events", EVENTS, _events_spark, EVENTS_SQL),
    )
}

# Events as JSON landing files: one file per (day, event_id div 1000).
EVENTS_JSON_SQL = _text_sql(
    "strftime(ts, '%Y-%m-%d') || '_' || CAST(event_id // 1000 AS VARCHAR)",
    "event_id",
    {
        "event_id": "CAST(event_id AS VARCHAR)",
        "ts": "CASE WHEN event_id % 53 = 0 THEN replace(strftime(ts, '%Y-%m-%d %H:%M:%S'), ' ', 'T') "
        "WHEN event_id % 59 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END",
        "user_id": "CASE WHEN event_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END",
        "event_type": "CASE WHEN event_id % 5 <> 0 THEN event_type END",
        "value": "CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)",
        "props": "props",
    },
    "events",
)


def _in_files(text_sql: str) -> str:
    """Rows as landing files hold them: ``index`` is the place in the file, ordered by the row key."""
    place = 'row_number() OVER (PARTITION BY source_filename ORDER BY "index") - 1'
    return f'SELECT * REPLACE ({place} AS "index") FROM ({text_sql})'


EVENTS_JSON_SQL = _in_files(EVENTS_JSON_SQL)
# Orders and lineitem as landing files: by status / return flag and a million keys.
ORDERS_FILES_SQL = _in_files(ORDERS_SQL.replace(
    "'orders/' || o_orderstatus || '.csv' AS source_filename",
    "o_orderstatus || '_' || CAST(o_orderkey // 1000000 AS VARCHAR) AS source_filename", 1,
))
DOCUMENTS_FILES_SQL = _in_files(DOCUMENTS_SQL.replace(
    "SELECT source AS source_filename", "SELECT source || '_' || CAST(doc_id // 1000000 AS VARCHAR) AS source_filename", 1,
))
LINEITEM_FILES_SQL = _in_files(LINEITEM_SQL.replace(
    "'lineitem/lineitem.csv' AS source_filename",
    "l_returnflag || '_' || CAST(l_orderkey // 1000000 AS VARCHAR) AS source_filename", 1,
))


# Orders with keys of 16 to 19 digits, some of them beyond bigint.
def _wide_keys_spark(spark: SparkSession, sf: str) -> DataFrame:
    o = spark.read.parquet(f"{sf}/orders.parquet")
    k = F.col("o_orderkey")
    n = k.cast("decimal(19,0)")
    at = lambda digits: F.lit(digits).cast("decimal(19,0)")
    texts = {
        "o_orderkey": F.when(k % 11 == 0, _s(at("9223372036854775807") + n))
        .when(k % 2 == 0, _s(at("9223372036854775807") - n))
        .otherwise(_s(at("9007199254740993") + n)),
    }
    return table_records(o, WIDE_KEYS, F.lit("orders/wide.csv"), k, texts)


WIDE_KEYS = rules_of(col("o_orderkey", "INTEGER", "REQUIRED", key=True), col("o_custkey", "INTEGER"))
WIDE_KEYS_SQL = _text_sql(
    "'orders/wide.csv'",
    "o_orderkey",
    {
        "o_orderkey": "CAST(CASE WHEN o_orderkey % 11 = 0 THEN CAST(9223372036854775807 AS HUGEINT) + o_orderkey "
        "WHEN o_orderkey % 2 = 0 THEN CAST(9223372036854775807 AS HUGEINT) - o_orderkey "
        "ELSE CAST(9007199254740993 AS HUGEINT) + o_orderkey END AS VARCHAR)",
        "o_custkey": "CAST(o_custkey AS VARCHAR)",
    },
    "orders",
)
DATASETS["wide_keys"] = Dataset("wide_keys", WIDE_KEYS, _wide_keys_spark, WIDE_KEYS_SQL)


# Documents with separators, quotes and outer blanks in a value, in files of 10,000 keys.
def _noted_spark(spark: SparkSession, sf: str) -> DataFrame:
    d = spark.read.parquet(f"{sf}/documents.parquet")
    k = F.col("doc_id")
    note = F.concat(F.lit("  "), F.col("lang"), F.lit(' "'), F.col("source"), F.lit('"; '))
    file = F.concat_ws("_", "lang", F.floor(k / 10_000).cast("string"))
    return table_records(d, NOTED, file, k, {"note": note})


NOTED = rules_of(col("doc_id", "INTEGER", "REQUIRED", key=True), col("text"), col("note"))
NOTED_SQL = _text_sql(
    "lang || '_' || CAST(doc_id // 10000 AS VARCHAR)",
    "doc_id",
    {
        "doc_id": "CAST(doc_id AS VARCHAR)",
        "text": "text",
        "note": "'  ' || lang || ' \"' || source || '\"; '",
    },
    "documents",
)
DATASETS["noted"] = Dataset("noted", NOTED, _noted_spark, NOTED_SQL)


# Orders whose dates have no declared format: each file shows its own, by status, and holds others.
def _undeclared_spark(spark: SparkSession, sf: str) -> DataFrame:
    o = spark.read.parquet(f"{sf}/orders.parquet")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    shown = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(d, "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "O", F.date_format(d, "dd/MM/yyyy"))
        .otherwise(F.date_format(d, "d MMMM yyyy"))
    )
    day = (
        F.when(k % 9 == 0, F.date_format(d, "yyyy-MM-dd HH:mm:ss")).when(k % 50 == 0, F.lit(None))
        .when(k % 97 == 0, F.lit("99999-01-01")).otherwise(shown)
    )
    file = F.concat_ws("_", "o_orderstatus", F.floor(k / 500).cast("string"))
    return table_records(o, UNDECLARED, file, k, {"o_orderkey": _s(k), "o_orderdate": day})


UNDECLARED = rules_of(col("o_orderkey", "INTEGER", "REQUIRED"), col("o_orderdate", "DATETIME"))
UNDECLARED_SQL = _text_sql(
    "o_orderstatus || '_' || CAST(o_orderkey // 500 AS VARCHAR)",
    "o_orderkey",
    {
        "o_orderkey": "CAST(o_orderkey AS VARCHAR)",
        "o_orderdate": "CASE WHEN o_orderkey % 9 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') "
        "WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN '99999-01-01' "
        "WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') "
        "WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%-d %B %Y') END",
    },
    "orders",
)
DATASETS["undeclared"] = Dataset("undeclared", UNDECLARED, _undeclared_spark, UNDECLARED_SQL)

#: The rows above with the date that their file's first value lets them have (null: none).
_SHOWN = ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%m/%d/%Y", "%d/%m/%Y", "%d %B %Y")
_PARSED = [f"try_strptime(x, '{f}')" for f in _SHOWN]
UNDECLARED_PARSED_SQL = (
    f"WITH t AS (SELECT *, coalesce(o_orderdate, '1900-01-01') AS x FROM ({UNDECLARED_SQL})), "
    "firsts AS (SELECT source_filename AS f, arg_min(x, \"index\") AS x FROM t GROUP BY ALL), "
    "formats AS (SELECT f, CASE " + " ".join(f"WHEN {p} IS NOT NULL THEN {k}" for k, p in enumerate(_PARSED)) + " END AS format FROM firsts), "
    "read AS (SELECT t.*, CASE format " + " ".join(f"WHEN {k} THEN {p}" for k, p in enumerate(_PARSED)) + f" ELSE coalesce({', '.join(_PARSED)}) END AS v "
    "FROM t JOIN formats ON f = source_filename), "
    "dated AS (SELECT * REPLACE (CASE WHEN v BETWEEN TIMESTAMP '1677-09-21 00:12:43.145225' AND TIMESTAMP '2262-04-11 23:47:16.854775' THEN v END AS v) FROM read) "
)
