"""The driver's correctness gate at sf0.001: every registered query equals its
DuckDB oracle SQL (rows, column names, order-insensitive values)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    spark_cols, spark_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    duck_cols, duck_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(spark_cols) == sorted(duck_cols)
    assert len(spark_rows) == len(duck_rows)
    assert digest(spark_cols, spark_rows)[0] == digest(duck_cols, duck_rows)[0]
