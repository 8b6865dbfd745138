"""Row rules (R1-R6) on small frames: the row cases of FIXTURES.md."""

import pytest
from conftest import rules

from sluice.plans.validate import check_records

TS = "2024-01-01 00:00:00"


def records(spark, rows, cols):
    schema = "source_filename string, index bigint, " + ", ".join(f"`{c}` string" for c in cols)
    return spark.createDataFrame(rows, schema)


def run(spark, name, rows, **kw):
    r = rules(name, **kw)
    df = records(spark, rows, [c.name for c in r.data_columns])
    return check_records(df, r, table=name, ingest_ts=TS)


def test_several_violations_one_row(spark):
    res = run(spark, "clinical_trials", [
        ("f.csv", 0, "A", None, "1 Jan 2020", "j"),
        ("f.csv", 1, "A", "t", "1 January 2020", "j"),
    ])
    inv = {(r["index"], r.invalid_code, r.invalid_col_name, r.invalid_reason, r.invalid_col_value)
           for r in res.data_invalid.collect()}
    assert inv == {
        (0, "NULL_VALUE_NOT_EXPECTED", "scientific_title", "scientific_title is NULL whereas it is REQUIRED", None),
        (0, "KEY_NOT_UNIQUE", "['id']", "['id'] is not unique : 2 occurences", "['A']"),
        (1, "KEY_NOT_UNIQUE", "['id']", "['id'] is not unique : 2 occurences", "['A']"),
        (0, "COLUMN_NOT_PARSABLE", "date", "date is not parsable to DATE", "1 Jan 2020"),
    }
    s = res.rows_stats.collect()[0]
    assert (s.nb_valid_lines, s.nb_invalid_lines) == (0, 2)
    assert s.nb_invalid_lines_NULL_VALUE_NOT_EXPECTED == 1
    assert s.nb_invalid_lines_KEY_NOT_UNIQUE == 2
    assert s.nb_invalid_lines_COLUMN_NOT_PARSABLE == 1
    assert res.valid.count() == 0


def test_composite_key_with_null_and_text_compare(spark):
    res = run(spark, "prices", [
        ("f.csv", 0, "x", None, "1", None),
        ("f.csv", 1, "x", None, "2", None),
        ("f.csv", 2, "y", "1", None, None),
        ("f.csv", 3, "y", "01", None, None),
        ("f.csv", 4, "y", "1.0", None, None),
    ])
    keys = [r for r in res.data_invalid.collect() if r.invalid_code == "KEY_NOT_UNIQUE"]
    assert sorted(r["index"] for r in keys) == [0, 1]
    assert {r.invalid_col_name for r in keys} == {"['shop', 'sku']"}
    assert {r.invalid_col_value for r in keys} == {"['x','nan']"}


def test_key_scope_is_one_file(spark):
    res = run(spark, "drugs", [("a.csv", 0, "K", "d"), ("b.csv", 0, "K", "d")])
    assert res.data_invalid.count() == 0
    assert res.valid.count() == 2


def test_null_date_policy(spark):
    rows = [("f.csv", 0, "A", "t", None, "j")]
    assert run(spark, "clinical_trials", rows).data_invalid.count() == 1
    assert run(spark, "clinical_trials", rows, null_dates_pass=True).data_invalid.count() == 0


def test_all_null_rows_dropped_and_newlines(spark):
    res = run(spark, "drugs", [
        ("f.csv", 0, None, None),
        ("f.csv", 1, "K", "a\nb\n"),
    ])
    rows = res.valid.collect()
    assert [(r.atcode, r.drug) for r in rows] == [("K", "a b ")]
    assert res.rows_stats.collect()[0].nb_valid_lines == 1


def test_typed_valid_rows(spark):
    res = run(spark, "prices", [("f.csv", 0, "s", "10.0", "1.234,5", "2020-01-02 03:04:05")])
    r = res.valid.collect()[0]
    assert r.sku == 10 and r.price == 1234.5
    assert str(r.seen_at) == "2020-01-02 03:04:05"
    assert r.source_filename == "f.csv" and str(r.execution_datetime) == TS
    assert res.valid.columns == ["shop", "sku", "price", "seen_at", "source_filename", "execution_datetime"]


def test_report_schemas(spark):
    from sluice.schemas import DATA_INVALID, ROWS_STATS

    res = run(spark, "drugs", [("f.csv", 0, None, "d")])
    assert [(f.name, f.dataType) for f in res.data_invalid.schema] == [(f.name, f.dataType) for f in DATA_INVALID]
    assert [f.name for f in res.rows_stats.schema] == [f.name for f in ROWS_STATS]
    assert [f.dataType for f in res.rows_stats.schema] == [f.dataType for f in ROWS_STATS]


def test_hot_key_uses_shuffle_join_when_over_budget(spark):
    """Over the broadcast budget the duplicate table is shuffle-joined; same result."""
    rows = [("f.csv", i, "HOT" if i % 3 else f"k{i}", "d") for i in range(300)]
    r = rules("drugs")
    df = records(spark, rows, [c.name for c in r.data_columns])
    from sluice.operators.rowchecks import annotate, normalise

    a, _ = annotate(normalise(df, r, TS), r, budget=0)
    b, _ = annotate(normalise(df, r, TS), r, budget=10**9)
    assert sorted(map(tuple, a.select("index", "violations").collect())) == sorted(
        map(tuple, b.select("index", "violations").collect())
    )
    assert a.where("size(violations) > 0").count() == 200


def test_two_phase_key_count_equals_direct(spark):
    """Hash-first duplicate counting gives exactly the direct result (nulls too)."""
    import random

    from sluice.operators.keys import duplicate_groups, duplicate_groups_two_phase

    r = random.Random(3)
    rows = [
        (f"f{r.randint(0, 2)}.csv", i, r.choice(["a", "b", "", None, "a b " * 50]), r.choice(["1", None, "2"]))
        for i in range(2000)
    ]
    df = spark.createDataFrame(rows, "source_filename string, index bigint, k1 string, k2 string")
    def key(t):
        return tuple("\0" if v is None else str(v) for v in t)

    want = sorted(map(tuple, duplicate_groups(df, ["k1", "k2"]).collect()), key=key)
    assert len(want) > 10
    for budget in (0, 10**9):
        got = sorted(map(tuple, duplicate_groups_two_phase(df, ["k1", "k2"], budget=budget).collect()), key=key)
        assert got == want


def test_key_count_releases_its_hash_groups(spark):
    from sluice.operators.keys import with_key_counts

    persistent = spark.sparkContext._jsc.getPersistentRDDs
    before = persistent().size()
    df = spark.createDataFrame([("f", "a"), ("f", "a"), ("f", "b")], "source_filename string, k string")
    out, dups = with_key_counts(df, ["k"], two_phase=True)
    assert sorted(r["_key_count"] or 1 for r in out.collect()) == [1, 2, 2]
    dups.unpersist()
    assert persistent().size() <= before


def test_key_join_beyond_the_budget_sorts_hashes_only(spark):
    from sluice.operators.keys import with_key_counts

    rows = [("f", "a" * 500, None), ("f", "a" * 500, None), ("f", "b", "c"), ("g", None, None), ("g", None, None)]
    df = spark.createDataFrame(rows, "source_filename string, k1 string, k2 string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out, dups = with_key_counts(df, ["k1", "k2"], budget=0)
        assert sorted(r["_key_count"] or 1 for r in out.collect()) == [1, 2, 2, 2, 2]
        joins = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "SortMergeJoin" in x]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joins and all("k1" not in x and "_h1" in x for x in joins)
    dups.unpersist()


FIRST_VALUES = [
    "2020-01-02", "2020/01/02", "2020.01.02", "2020 01 02", "01/02/2020", "1/2/2020", "13/01/2020", "01-02-2020", "13-01-2020", "01.02.2020", "13.01.2020",
    "1 January 2020", "May 1, 2020", "Jan 1, 2020", "1 Jan 2020", "01-Jan-2020", "01-January-2020", "20200102", "20200102101112", "2020-01", "2020",
    "2020-01-02 10:11", "2020-01-02 10:11:12", "2020-01-02T10:11:12", "2020-01-02 10:11:12.5", "01/02/2020 10:11:12", "1 January 2020 10:11:12",
    "99999-01-01", "garbage", "2020-13-01", None,
]


@pytest.mark.parametrize("budget", [None, 0])
def test_dates_without_a_format_follow_the_first_value(spark, budget):
    """Against pandas.to_datetime(format=None) of each file's column: every first value, then all values."""
    import warnings

    import pandas as pd

    from sluice.operators.rowchecks import annotate, normalise
    from sluice.rules import ColumnRule, TableRules

    lineage = (ColumnRule("source_filename", "STRING"), ColumnRule("execution_datetime", "DATETIME"))
    r = TableRules(columns=(ColumnRule("k", "STRING", "k"), ColumnRule("d", "DATETIME", "d"), *lineage))
    rows = [(f"f{i}", j, f"{j}", v) for i, first in enumerate(FIRST_VALUES) for j, v in enumerate([first, *FIRST_VALUES, "25/12/2021", "04/05/2021 1:02"])]
    df = spark.createDataFrame(rows, "source_filename string, index long, k string, d string").repartition(5)
    annotated, cached = annotate(normalise(df, r, "2024-01-01 00:00:00"), r, budget=budget)
    got = {(x.source_filename, x["index"]): x._p_d for x in annotated.collect()}
    for c in cached:
        c.unpersist()
    frame = pd.DataFrame(rows, columns=["f", "i", "k", "d"])
    for f, part in frame.groupby("f"):
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            want = pd.to_datetime(part.d.fillna("1900-01-01"), errors="coerce")
        for i, w in zip(part.i, want):
            assert got[f, i] == (None if pd.isna(w) else w.to_pydatetime()), (f, part.d.iloc[0], part.d.iloc[i])


def test_numbers_that_no_bigint_holds_are_reported(spark):
    from sluice.plans.validate import check_records
    from sluice.rules import ColumnRule, TableRules

    lineage = (ColumnRule("source_filename", "STRING"), ColumnRule("execution_datetime", "DATETIME"))
    r = TableRules(columns=(ColumnRule("k", "INTEGER", "k"), *lineage))
    texts = ["1", "10.0", "1e3", "10.05", "1e30", "9223372036854775807", "9223372036854775808", "inf", "x", "1.5"]
    df = spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], "source_filename string, index long, k string")
    res = check_records(df, r, ingest_ts="2024-01-01 00:00:00")
    assert {x.invalid_col_value for x in res.data_invalid.collect()} == {"x", "1.5"}
    got = {x.invalid_col_value: (x.invalid_code, x.invalid_col_name, x["index"]) for x in res.not_loadable.collect()}
    assert got == {t: ("VALUE_NOT_LOADABLE", "k", texts.index(t)) for t in ("10.05", "1e30", "9223372036854775808", "inf")}
    assert sorted(x.k for x in res.valid.collect() if x.k is not None) == [1, 10, 1000, 2**63 - 1]
    assert res.valid.count() == 8
    res.release()
