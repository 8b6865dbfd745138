"""Sinks and the registry run (S5, S6, K1-K4)."""

import os
import tempfile

import pytest
from conftest import FIXTURES, rules

from sluice.plans.landing import check_landing
from sluice.plans.run import run_landing
from sluice.rules import RuleError, RunConfig, TableConfig
from sluice import swap
from sluice.sinks import SchemaMismatch, append_reports, export_csv, load_valid, read_table, write_table

TS = "2024-01-01 00:00:00"


def test_append_truncate_and_empty_guard(spark, landing):
    out = tempfile.mkdtemp(prefix="sluice-out-")
    landing("drugs/drugs.csv", "atccode;drug\nA;1\nB;2\n")
    res = check_landing(spark, landing.root, rules("drugs"), table="drugs", ingest_ts=TS)
    target = os.path.join(out, "raw", "drugs")
    assert load_valid(res.valid, target, "APPEND")
    assert load_valid(res.valid, target, "APPEND")
    assert read_table(spark, target).count() == 4
    assert load_valid(res.valid, target, "TRUNCATE")
    assert read_table(spark, target).count() == 2
    # K4: nothing valid -> no write, TRUNCATE keeps the old rows.
    assert not load_valid(res.valid.limit(0), target, "TRUNCATE")
    assert read_table(spark, target).count() == 2
    with pytest.raises(ValueError):
        load_valid(res.valid, target, "MERGE")
    paths = [os.path.join(out, "dq", n) for n in ("file_stats", "rows_stats", "data_invalid")]
    append_reports(res, *paths)
    append_reports(res, *paths)
    assert read_table(spark, paths[0]).count() == 2
    assert read_table(spark, paths[1]).count() == 2
    export_csv(res.file_stats, os.path.join(out, "export", "file_stats"))
    back = spark.read.option("header", True).option("sep", ";").csv(os.path.join(out, "export", "file_stats"))
    assert back.columns[:3] == ["pipeline", "dataset", "table"]


@pytest.mark.parametrize("parallel", [1, 2])
def test_registry_run(spark, landing, parallel):
    out = tempfile.mkdtemp(prefix="sluice-out-")
    landing("clinical_trials/clinical_trials.csv",
            "id;scientific_title;date;journal\nA;t;1 January 2020;j\nB;t;x;j\n")
    landing("drugs/drugs.csv", "atccode;drug\nA;1\n")
    landing("pubmed/pubmed.csv", "id;title;date;journal\n1;t;01/01/2020;j\n")
    cfg = RunConfig.load(os.path.join(FIXTURES, "config.yml"))
    runs = run_landing(spark, cfg, landing.root, out, parallel_tables=parallel)
    assert [r.name for r in runs] == ["clinical_trials", "drugs"]  # pubmed: to_request False
    assert all(r.error is None for r in runs), [r.error for r in runs]
    ct = read_table(spark, os.path.join(out, "raw", "clinical_trials"))
    assert [r.id for r in ct.collect()] == ["A"]
    inv = read_table(spark, os.path.join(out, "data_quality", "data_invalid"))
    assert [r.invalid_col_value for r in inv.collect()] == ["x"]
    fs = read_table(spark, os.path.join(out, "data_quality", "file_stats"))
    assert fs.count() == 2


def test_rule_validation():
    from sluice.rules import ColumnRule, TableRules

    with pytest.raises(RuleError):
        TableRules(columns=(ColumnRule("a", "STRING", "a"),))
    lin = (ColumnRule("source_filename", "STRING"), ColumnRule("execution_datetime", "DATETIME"))
    with pytest.raises(RuleError):
        TableRules(columns=(ColumnRule("a", "DECIMAL", "a"), *lin))
    with pytest.raises(RuleError):
        TableConfig("t", "r.json", "raw", "t", write_mode="MERGE")
    assert TableRules(columns=(ColumnRule("a", "INTEGER", "a"), *lin)).header == ["a"]


def test_export_sorted_report(spark, landing):
    """O1: the CSV export of data_invalid is ordered by table, file, index."""
    out = tempfile.mkdtemp(prefix="sluice-out-")
    rows = "".join(f"K{i % 5};\n" for i in range(40))
    landing("drugs/drugs_b.csv", "atccode;drug\n" + rows)
    landing("drugs/drugs_a.csv", "atccode;drug\n" + rows)
    res = check_landing(spark, landing.root, rules("drugs"), table="drugs", ingest_ts=TS)
    path = os.path.join(out, "data_invalid")
    export_csv(res.data_invalid, path, ["table", "source_filename", "index"])
    back = spark.read.option("header", True).option("sep", ";").csv(path).collect()
    keys = [(r.source_filename, int(r["index"])) for r in back]
    assert keys == sorted(keys) and len(keys) == 160  # 80 rows x (null + key)


def test_registry_run_exports_reports(spark, landing):
    out = tempfile.mkdtemp(prefix="sluice-out-")
    exp = tempfile.mkdtemp(prefix="sluice-export-")
    landing("drugs/drugs.csv", "atccode;drug\nA;1\nA;2\n")
    cfg = RunConfig.load(os.path.join(FIXTURES, "config.yml"))
    cfg = RunConfig(tables=tuple(t for t in cfg.tables if t.name == "drugs"))
    runs = run_landing(spark, cfg, landing.root, out, export_root=exp)
    assert runs[0].error is None and not runs[0].loaded  # both rows share a key: nothing valid
    base = os.path.join(exp, "data_quality", "drugs")
    read = spark.read.option("header", True).option("sep", ";")
    fs = read.csv(os.path.join(base, "file_stats")).collect()
    assert len(fs) == 1 and fs[0].is_invalid == "False"
    assert len(fs[0].date_ingest) == 19 and fs[0].date_ingest[10] == " "  # 'YYYY-MM-DD HH:MM:SS'
    assert read.csv(os.path.join(base, "rows_stats")).first().nb_invalid_lines == "2"
    inv = read.csv(os.path.join(base, "data_invalid")).collect()
    assert [r["index"] for r in inv] == ["0", "1"]
    assert {r.invalid_col_value for r in inv} == {"['A']"}


def test_export_keeps_blanks_and_doubles_quotes(spark, tmp_path):
    df = spark.createDataFrame([("  x 1 ", 'he said "no"; ok', 2), ("b", "c", 1)], "a string, b string, i int")
    export_csv(df, str(tmp_path / "out"), ["i"], drop=["i"])
    lines = [x for p in sorted((tmp_path / "out").glob("part-*")) for x in p.read_text().splitlines() if x != "a;b"]
    assert lines == ["b;c", '  x 1 ;"he said ""no""; ok"']


@pytest.fixture(params=["path", "catalog"])
def target(request, spark, tmp_path):
    if request.param == "path":
        yield str(tmp_path / "raw" / "kept")
        return
    spark.sql("CREATE DATABASE IF NOT EXISTS swaps LOCATION '%s'" % (tmp_path / "swaps"))
    yield "swaps.kept"
    spark.sql("DROP DATABASE swaps CASCADE")


def _rows(spark, target):
    return sorted(r.n for r in read_table(spark, target).collect())


def test_failed_truncate_keeps_the_rows(spark, target):
    """Half of the tasks have written their rows when one fails."""
    write_table(spark.range(10).withColumnRenamed("id", "n"), target, "TRUNCATE")
    assert _rows(spark, target) == list(range(10))
    broken = spark.range(100, 200, 1, 4).selectExpr("CASE WHEN id = 190 THEN raise_error('lost') ELSE id END AS n")
    with pytest.raises(Exception, match="lost"):
        write_table(broken, target, "TRUNCATE")
    assert _rows(spark, target) == list(range(10))
    old = read_table(spark, target)
    write_table(old.selectExpr("n + 5 AS n"), target, "TRUNCATE")  # reads what it replaces
    assert _rows(spark, target) == list(range(5, 15))
    assert not any(swap._store(spark, target).exists(role) for role in swap.ROLES)


@pytest.mark.parametrize("stop", ["ready", "old", "table"])
@pytest.mark.parametrize("there", [True, False])
def test_cut_off_replacement_is_finished(spark, target, stop, there):
    """Once the new rows are complete, a reader after a lost driver sees them, wherever it stopped."""
    if there:
        write_table(spark.range(3).withColumnRenamed("id", "n"), target, "TRUNCATE")
    elif stop == "old":
        pytest.skip("no old table to move")
    steps = swap.replace_steps(spark.range(7).withColumnRenamed("id", "n"), target)
    while next(steps) != stop:
        pass
    steps.close()
    assert _rows(spark, target) == list(range(7))
    assert not any(swap._store(spark, target).exists(role) for role in swap.ROLES)
    write_table(spark.range(1).withColumnRenamed("id", "n"), target, "TRUNCATE")
    assert _rows(spark, target) == [0]


def test_rows_left_by_a_killed_writer_are_no_rows(spark, target):
    write_table(spark.range(3).withColumnRenamed("id", "n"), target, "TRUNCATE")
    swap._store(spark, target).write(spark.range(9).withColumnRenamed("id", "n"), "writing")
    assert _rows(spark, target) == [0, 1, 2]
    write_table(spark.range(4).withColumnRenamed("id", "n"), target, "TRUNCATE")
    assert _rows(spark, target) == [0, 1, 2, 3]


def test_append_needs_the_table_s_columns(spark, target):
    df = spark.sql("SELECT 1L AS n, 'a' AS s")
    write_table(df, target, "APPEND")
    for other in ("SELECT '1' AS n, 'a' AS s", "SELECT 1L AS n", "SELECT 1L AS n, 'a' AS s, 2 AS more"):
        with pytest.raises(SchemaMismatch):
            write_table(spark.sql(other), target, "APPEND")
    write_table(spark.sql("SELECT 'b' AS s, 2L AS n"), target, "APPEND")  # by name
    assert sorted(tuple(r) for r in read_table(spark, target).select("n", "s").collect()) == [(1, "a"), (2, "b")]
    write_table(spark.sql("SELECT '1' AS n"), target, "TRUNCATE")  # the new rows bring their own columns
    assert read_table(spark, target).dtypes == [("n", "string")]


@pytest.mark.parametrize("killed", [1, 2, 3, 4, "load"])
def test_repeated_run_gives_the_same_tables(spark, landing, tmp_path, monkeypatch, killed):
    """A run killed while it moves its nth appended table's files, or before the load, and then repeated twice."""
    import sluice.plans.run as run_module
    from sluice.ledger import Ledger

    landing("drugs/drugs.csv", "atccode;drug\nA;1\nB;\nC;2\n")
    cfg = RunConfig.load(os.path.join(FIXTURES, "config.yml"))
    cfg = RunConfig(tables=tuple(t for t in cfg.tables if t.name == "drugs"))
    out, move, load = str(tmp_path), Ledger._move, run_module.load_valid
    calls = []

    def cut(self, aside, target, entry):
        calls.append(entry)
        if len(calls) == killed:
            fs, path = self._at(aside)
            part = next(s for s in fs.listStatus(path) if s.getPath().getName().startswith("part-"))
            fs.mkdirs(self._at(target)[1])
            fs.rename(part.getPath(), self._at(f"{target}/{self.run}-{entry}-{part.getPath().getName()}")[1])  # one file has moved
            raise RuntimeError("killed")
        move(self, aside, target, entry)

    monkeypatch.setattr(Ledger, "_move", cut)
    if killed == "load":
        monkeypatch.setattr(run_module, "load_valid", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    first = run_landing(spark, cfg, landing.root, out, run_id="run-1")[0]
    assert "killed" in first.error
    monkeypatch.setattr(Ledger, "_move", move)
    monkeypatch.setattr(run_module, "load_valid", load)
    for again in (False, True):
        run = run_landing(spark, cfg, landing.root, out, run_id="run-1")[0]
        assert (run.error, run.repeated, run.loaded, run.files, run.ingest_ts) == (None, again, True, 1, first.ingest_ts)
        assert sorted(r.atcode for r in read_table(spark, f"{out}/raw/drugs").collect()) == ["A", "C"]
        for name in ("file_stats", "rows_stats", "data_invalid"):
            assert read_table(spark, f"{out}/data_quality/{name}").count() == 1
    run_landing(spark, cfg, landing.root, out, run_id="run-2")
    assert read_table(spark, f"{out}/raw/drugs").count() == 4
    with pytest.raises(ValueError):
        run_landing(spark, cfg, landing.root, None, run_id="run-1")


def test_values_that_load_as_null_are_in_the_report(spark, landing, tmp_path):
    landing("pubmed/pubmed.csv", "id;title;date;journal\n10.05;t;01/01/2020;j\n2;t;01/01/2020;j\n")
    res = check_landing(spark, landing.root, rules("pubmed"), table="pubmed", ingest_ts=TS)
    paths = [str(tmp_path / n) for n in ("file_stats", "rows_stats", "data_invalid")]
    append_reports(res, *paths)
    assert [(r.invalid_code, r.invalid_col_value) for r in read_table(spark, paths[2]).collect()] == [("VALUE_NOT_LOADABLE", "10.05")]
    assert sorted(str(r.id) for r in res.valid.collect()) == ["2", "None"]
    res.release()
