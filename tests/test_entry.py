"""Driver contract of __spark_entry__."""

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "nb_valid_lines" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 20
