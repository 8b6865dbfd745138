"""Invariants over the driver tables (sf0.001): counts add up per file, and the
result does not depend on shuffle partitioning or on the key-join strategy."""

import pytest
from pyspark.sql import functions as F

from sluice.catalog.datasets import DATASETS, INGEST_TS
from sluice.operators.rowchecks import normalise
from sluice.plans.validate import check_records

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["orders", "part", "documents", "customer", "events"])
def test_counts_add_up(spark, name):
    ds = DATASETS[name]
    recs = ds.spark_records(spark, SF)
    res = check_records(recs, ds.rules, table=name, ingest_ts=INGEST_TS)
    rows = {r.source_filename: r.n for r in normalise(recs, ds.rules, INGEST_TS)
            .groupBy("source_filename").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad = {r.source_filename: r.n for r in res.data_invalid.groupBy("source_filename")
           .agg(F.countDistinct("index").alias("n")).collect()}
    valid = {r.source_filename: r.n for r in res.valid.groupBy("source_filename")
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    for s in res.rows_stats.collect():
        f = s.source_filename
        assert s.nb_valid_lines + s.nb_invalid_lines == rows[f]
        assert s.nb_invalid_lines == bad.get(f, 0)
        assert s.nb_valid_lines == valid.get(f, 0)
        for code in ("NULL_VALUE_NOT_EXPECTED", "KEY_NOT_UNIQUE", "COLUMN_NOT_PARSABLE"):
            assert s[f"nb_invalid_lines_{code}"] <= s.nb_invalid_lines
    res.release()


def test_independent_of_partitioning_and_join_strategy(spark):
    ds = DATASETS["orders"]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    outs = []
    try:
        for parts, budget in (("3", "0"), ("17", str(1 << 30))):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("sluice.broadcast.maxBytes", budget)
            res = check_records(ds.spark_records(spark, SF), ds.rules, table="orders", ingest_ts=INGEST_TS)
            outs.append((sorted(map(tuple, res.data_invalid.collect())), sorted(map(tuple, res.rows_stats.collect()))))
            res.release()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("sluice.broadcast.maxBytes")
    assert outs[0] == outs[1]


@pytest.mark.parametrize("name", ["part", "lineitem", "documents", "events"])
def test_unique_keys_skip_the_shuffle_beyond_the_budget(spark, name):
    """With a budget of one byte the key counts are the same, and hardly a row of a unique key is joined."""
    from sluice.operators.keys import KEY_COUNT, _marked, duplicate_groups, key_hashes, with_key_counts

    ds = DATASETS[name]
    keys = ds.rules.key_columns
    norm = normalise(ds.spark_records(spark, SF), ds.rules, INGEST_TS)
    outs = []
    for budget in (1, 1 << 30):
        rows, dups = with_key_counts(norm, keys, budget=budget)
        outs.append(sorted(map(str, rows.select("source_filename", "index", KEY_COUNT).collect())))
        dups.unpersist()
    assert outs[0] == outs[1]
    groups = duplicate_groups(norm, keys)
    h1, h2 = key_hashes(keys)
    marked = _marked(norm.withColumns({"_h1": h1, "_h2": h2}), groups.withColumn("_dh1", h1), 1)
    shared = groups.select(*keys).distinct().count()
    in_keys = norm.join(groups.select(*[F.col(k).alias(f"d_{k}") for k in keys]).distinct(), [norm[k].eqNullSafe(F.col(f"d_{k}")) for k in keys]).count()
    maybe = marked.where("_maybe").count()
    assert in_keys <= maybe <= in_keys + (norm.count() - in_keys) * 2 * shared / (64 * 1024) + 30
