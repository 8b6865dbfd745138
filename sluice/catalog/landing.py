"""Landing folders written by Spark from the driver tables, for end-to-end queries.

Files go to the session's shared scratch folder (spark.checkpoint.dir). Each
landing file is one partition value, so its rows are whole and its key
scope is what the table queries call a pseudo file.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_scratch_path
from .datasets import DATASETS

FILE_TAG = "_file"
_CACHE: dict[tuple, str] = {}

CSV_WRITE = {
    "header": "true",
    "sep": ";",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _key(spark: SparkSession, sf: str, name: str) -> tuple:
    return (spark.sparkContext.applicationId, sf, name)


def label(source_filename: str = "source_filename"):
    """The partition value a landing file was written under."""
    return F.regexp_extract(F.col(source_filename), FILE_TAG + "=([^/]+)/", 1)


#: Keys of a table in one landing file at most: files grow in number, not in size.
FILE_KEYS = 1_000_000


def file_tag(value, key):
    """One file per value and FILE_KEYS keys."""
    return F.concat_ws("_", value, F.floor(key / FILE_KEYS).cast("string"))


def _write_csv(records: DataFrame, tag, order, path: str, header: list[str], names: list[str]) -> None:
    """One file per tag, its rows by ``order``."""
    cells = [F.col(n).alias(h) for n, h in zip(names, header)]
    dealt = records.select(tag.alias(FILE_TAG), order.alias("_order"), *cells).repartition(FILE_TAG)
    (
        dealt.sortWithinPartitions(FILE_TAG, "_order")
        .drop("_order")
        .write.partitionBy(FILE_TAG)
        .options(**CSV_WRITE)
        .csv(path)
    )


def orders_landing(spark: SparkSession, sf: str) -> str:
    """root/orders/orders_csv/_file=<status>_<n>/part-*.csv (by status and key range),
    plus files that must fail the file checks: customer rows (wrong header)
    and region rows as .txt (unknown extension)."""
    key = _key(spark, sf, "orders")
    if key in _CACHE:
        return _CACHE[key]
    root = new_scratch_path(spark, "landing-orders")
    ds = DATASETS["orders"]
    rules = ds.rules
    names = [c.name for c in rules.data_columns]
    recs = ds.spark_records(spark, sf)
    _write_csv(
        recs, file_tag(F.regexp_extract("source_filename", r"orders/(.+)\.csv", 1), F.col("index")), F.col("index"),
        f"{root}/orders/orders_csv", rules.header, names,
    )
    cust = spark.read.parquet(f"{sf}/customer.parquet")
    cols = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    _write_csv(
        cust.select(*[F.col(c).cast("string").alias(c) for c in cols], F.col("c_custkey").alias("key")),
        file_tag(F.col("c_mktsegment"), F.col("key")), F.col("key"), f"{root}/orders/orders_customer", cols, cols,
    )
    region = spark.read.parquet(f"{sf}/region.parquet")
    region.select(F.concat_ws(";", F.col("r_regionkey").cast("string"), "r_name")).coalesce(1).write.text(
        f"{root}/orders/orders_region"
    )
    # Unreadable: the orders header, a first nation row as wide as the header,
    # then nation rows one field wider (pandas: "Expected 7 fields, saw 8").
    # One file, lines in order: header, then rows by nation key.
    nation = spark.read.parquet(f"{sf}/nation.parquet")
    width = len(rules.header)
    header = nation.select(
        F.lit(";".join(rules.header)).alias("value"), F.lit(-1).cast("long").alias("_o")
    ).distinct()
    first = F.col("n_nationkey") == nation.agg(F.min("n_nationkey")).first()[0]
    cells = [F.col("n_nationkey").cast("string"), F.col("n_name")]
    cells += [F.col("n_regionkey").cast("string")] * (width - 2)
    body = nation.select(
        F.when(first, F.concat_ws(";", *cells))
        .otherwise(F.concat_ws(";", *cells, F.col("n_regionkey").cast("string")))
        .alias("value"),
        F.col("n_nationkey").cast("long").alias("_o"),
    )
    wide = f"{root}/orders/orders_wide"
    header.unionByName(body).coalesce(1).sortWithinPartitions("_o").select("value").write.text(wide)
    _rename_suffix(spark, f"{wide}/part-*.txt", ".txt", ".csv")
    _CACHE[key] = root
    return root


LANDING_FORMATS = {"csv": {"separator": ";", "encoding": "utf-8"}, "json": {}}


def orders_landing_rules():
    return dataclasses.replace(
        DATASETS["orders"].rules, source_path="orders/orders", formats=LANDING_FORMATS
    )


def _rename_suffix(spark: SparkSession, pattern: str, old: str, new: str) -> None:
    """Give Spark's text part files another extension (fixture preparation)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    glob = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = glob.getFileSystem(conf)
    for st in fs.globStatus(glob) or []:
        p = st.getPath().toString()
        fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(p[: -len(old)] + new))


EVENTS_BUCKET_ROWS = 1000


def events_json_landing(spark: SparkSession, sf: str) -> str:
    """root/events/events_json/_file=<day>_<bucket>/part-*.json: one JSON array of
    objects per (day, event_id div 1000); the objects keep null members."""
    key = _key(spark, sf, "events_json")
    if key in _CACHE:
        return _CACHE[key]
    root = new_scratch_path(spark, "landing-events")
    from .datasets import events_records

    ds = DATASETS["events"]
    day_bucket = F.concat_ws(
        "_", F.date_format("ts", "yyyy-MM-dd"),
        F.expr(f"event_id div {EVENTS_BUCKET_ROWS}").cast("string"),
    )
    recs = events_records(spark, sf, day_bucket)
    names = [c.name for c in ds.rules.data_columns]
    obj = F.to_json(
        F.struct(*[F.col(n).alias(h) for n, h in zip(names, ds.rules.header)]),
        {"ignoreNullFields": "false"},
    )
    tag = F.col("source_filename")
    # Groups hold at most EVENTS_BUCKET_ROWS objects; array order is event_id.
    docs = (
        recs.groupBy(tag.alias(FILE_TAG))
        .agg(F.array_sort(F.collect_list(F.struct("index", obj.alias("j")))).alias("objs"))
        .select(FILE_TAG, F.concat(F.lit("["), F.array_join(F.col("objs.j"), ","), F.lit("]")).alias("value"))
    )
    path = f"{root}/events/events_json"
    docs.repartition(FILE_TAG).write.partitionBy(FILE_TAG).text(path)
    _rename_suffix(spark, f"{path}/*/part-*.txt", ".txt", ".json")
    # Unreadable: one file a region, cut off in its first object.
    cut = f"{root}/events/events_cut"
    region = spark.read.parquet(f"{sf}/region.parquet").select(
        F.col("r_name").alias(FILE_TAG), F.concat(F.lit('[{"event_id": "'), F.col("r_regionkey")).alias("value")
    )
    region.repartition(FILE_TAG).write.partitionBy(FILE_TAG).text(cut)
    _rename_suffix(spark, f"{cut}/*/part-*.txt", ".txt", ".json")
    _CACHE[key] = root
    return root


def events_json_rules():
    return dataclasses.replace(
        DATASETS["events"].rules, source_path="events/events", formats=LANDING_FORMATS
    )


def lineitem_landing(spark: SparkSession, sf: str) -> str:
    """root/lineitem/lineitem_csv/_file=<returnflag>_<n>/part-*.csv: big files by
    return flag and key range, read in line mode (splittable) by the landing query."""
    key = _key(spark, sf, "lineitem")
    if key in _CACHE:
        return _CACHE[key]
    root = new_scratch_path(spark, "landing-lineitem")
    ds = DATASETS["lineitem"]
    names = [c.name for c in ds.rules.data_columns]
    _write_csv(
        ds.spark_records(spark, sf), file_tag(F.col("l_returnflag"), F.floor(F.col("index") / 10)), F.col("index"),
        f"{root}/lineitem/lineitem_csv", ds.rules.header, names,
    )
    _CACHE[key] = root
    return root


def lineitem_landing_rules():
    return dataclasses.replace(
        DATASETS["lineitem"].rules, source_path="lineitem/lineitem", formats=LANDING_FORMATS
    )


def documents_landing(spark: SparkSession, sf: str) -> str:
    """root/documents/documents_csv/_file=<source>_<n>/part-*.csv: texts with newlines, in quotes."""
    key = _key(spark, sf, "documents")
    if key in _CACHE:
        return _CACHE[key]
    root = new_scratch_path(spark, "landing-documents")
    ds = DATASETS["documents"]
    names = [c.name for c in ds.rules.data_columns]
    _write_csv(
        ds.spark_records(spark, sf), file_tag(F.col("source_filename"), F.col("index")), F.col("index"),
        f"{root}/documents/documents_csv", ds.rules.header, names,
    )
    _CACHE[key] = root
    return root


def documents_landing_rules():
    return dataclasses.replace(
        DATASETS["documents"].rules, source_path="documents/documents", formats=LANDING_FORMATS
    )


def hidden_landing(spark: SparkSession, sf: str) -> str:
    """root/nation/nation_csv/_file=<region key>/: nation rows by region, in files whose names begin with
    a letter, _ or . in turn, and region rows in folders whose names begin with _."""
    key = _key(spark, sf, "hidden")
    if key in _CACHE:
        return _CACHE[key]
    root = new_scratch_path(spark, "landing-hidden")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, tag in (("nation", "n_regionkey"), ("region", "r_regionkey")):
        rows = spark.read.parquet(f"{sf}/{name}.parquet")
        cells = [F.col(f"{name[0]}_{c}").cast("string").alias(c) for c in ("regionkey", "name")]
        rows.select(F.col(tag).alias(FILE_TAG), *cells).repartition(FILE_TAG).write.partitionBy(FILE_TAG).options(**CSV_WRITE).csv(f"{root}/nation/nation_{name}")
    for st in fs.globStatus(path(f"{root}/nation/nation_nation/*/part-*.csv")) or []:
        folder = st.getPath().getParent()
        mark = ("n", "_", ".")[int(folder.getName().split("=")[1]) % 3]
        fs.rename(st.getPath(), path(folder, f"{mark}ation.csv"))
    fs.rename(path(f"{root}/nation/nation_region"), path(f"{root}/nation/nation_csv"))
    fs.rename(path(f"{root}/nation/nation_csv"), path(f"{root}/nation/nation_nation/_kept"))
    _CACHE[key] = root
    return root


def hidden_landing_rules():
    from .datasets import col, rules_of

    return dataclasses.replace(rules_of(col("regionkey", "INTEGER"), col("name", key=True)), source_path="nation/nation", formats=LANDING_FORMATS)


def write_registry(rules) -> str:
    """A registry file and the rule file it names, as a user writes them (on the driver, which reads them): the table
    ``orders`` by ``rules``, and one that is not requested. Returns the registry's path."""
    import json
    import os
    import tempfile

    import yaml

    folder = tempfile.mkdtemp(prefix="sluice-registry-")
    keys = ("expected_file_name", "name", "type", "mode", "unique_identifier", "date_format", "float_thousand_separator", "float_decimal_separator")
    content = {
        "source_path": rules.source_path, "file_info": {"name": "orders", "format": rules.formats},
        "schema": [{k: getattr(c, k) for k in keys} for c in rules.columns],
    }
    with open(os.path.join(folder, "orders.json"), "w", encoding="utf-8") as f:
        json.dump(content, f)
    entry = {"source_file_params": os.path.join(folder, "orders.json"), "destination_bq_dataset_name": "raw", "write_mode": "APPEND"}
    tables = {"orders": {"to_request": True, "destination_bq_table_name": "orders", **entry}, "later": {"to_request": False, "destination_bq_table_name": "later", **entry}}
    with open(os.path.join(folder, "config.yml"), "w", encoding="utf-8") as f:
        yaml.safe_dump({"version": 1, "tables": tables}, f)
    return os.path.join(folder, "config.yml")
