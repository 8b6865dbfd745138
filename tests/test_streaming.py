"""Incremental landing: only new files are checked; replays do not duplicate."""

import os
import tempfile

import pytest

from conftest import FIXTURES

from sluice.rules import RunConfig
from sluice.streaming import table_stream


def test_incremental_landing(spark, landing):
    cfg = RunConfig.load(os.path.join(FIXTURES, "config.yml"))
    drugs = next(t for t in cfg.tables if t.name == "drugs")
    out = tempfile.mkdtemp(prefix="sluice-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="sluice-stream-ckpt-")
    landing("drugs/drugs_1.csv", "atccode;drug\nA;1\nA;2\n")
    landing("drugs/drugs_2.csv", "atccode;drug\nB;1\n")
    q = table_stream(spark, drugs, landing.root, out, cfg, checkpoint=ckpt)
    q.awaitTermination(120)
    valid = spark.read.parquet(os.path.join(out, "raw", "drugs"))
    assert sorted(r.atcode for r in valid.collect()) == ["B"]
    landing("drugs/drugs_3.csv", "atccode;drug\nC;1\n")
    q = table_stream(spark, drugs, landing.root, out, cfg, checkpoint=ckpt)
    q.awaitTermination(120)
    valid = spark.read.parquet(os.path.join(out, "raw", "drugs"))
    assert sorted(r.atcode for r in valid.collect()) == ["B", "C"]
    fs = spark.read.parquet(os.path.join(out, "data_quality", "file_stats"))
    assert fs.count() == 3  # each file reported once
    inv = spark.read.parquet(os.path.join(out, "data_quality", "data_invalid"))
    assert inv.count() == 2


def test_default_checkpoint_is_stable_across_applications(spark):
    """Without checkpoint=, the stream state lives under spark.checkpoint.dir
    itself (not the per-application subfolder), so a new application resumes."""
    from sluice.rules import TableConfig
    from sluice.streaming.landing import default_checkpoint

    t = TableConfig("drugs", "r.json", "raw", "drugs")
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        with pytest.raises(ValueError):
            default_checkpoint(spark, t)
        return
    path = default_checkpoint(spark, t)
    assert path.startswith(base) and path.endswith(os.path.join("raw", "drugs"))
    app_dir = spark.sparkContext.getCheckpointDir()
    assert not app_dir or not path.startswith(app_dir.replace("file:", ""))


def test_two_tables_keep_their_reports_apart(spark, tmp_path):
    from sluice.streaming.landing import _write_batch
    from sluice.rules import TableConfig

    path = str(tmp_path / "file_stats")
    tables = [t for t in RunConfig.load(os.path.join(FIXTURES, "config.yml")).tables][:2]
    assert all(isinstance(t, TableConfig) for t in tables)
    for n, t in enumerate(tables):
        _write_batch(spark.range(n + 1), path, 0, t)
    assert spark.read.parquet(path).count() == 3


def test_names_are_literal(spark, landing):
    """A name with glob characters means that file alone; no other file is read twice or lost."""
    from pyspark.errors import AnalysisException

    from sluice.plans.landing import check_landing
    from sluice.rules import TableRules

    cfg = RunConfig.load(os.path.join(FIXTURES, "config.yml"))
    drugs = next(t for t in cfg.tables if t.name == "drugs")
    out, ckpt = tempfile.mkdtemp(prefix="sluice-stream-out-"), tempfile.mkdtemp(prefix="sluice-stream-ckpt-")
    names = ["drugs_1.csv", "drugs_[1].csv", "drugs_[2].csv", "drugs_{a,b}.csv", "drugs_*.csv", "drugs_?.csv"]
    for i, name in enumerate(names):
        landing(f"drugs/{name}", f"atccode;drug\nK{i};1\n")
    table_stream(spark, drugs, landing.root, out, cfg, checkpoint=ckpt).awaitTermination(120)
    valid = spark.read.parquet(os.path.join(out, "raw", "drugs"))
    assert sorted(r.atcode for r in valid.collect()) == [f"K{i}" for i in range(len(names))]
    fs = spark.read.parquet(os.path.join(out, "data_quality", "file_stats"))
    assert sorted(r.source_filename.split("/")[-1] for r in fs.collect()) == sorted(names)
    with pytest.raises(AnalysisException):
        check_landing(spark, landing.root, TableRules.load(drugs.rules_file), paths=[f"{landing.root}/drugs/none.csv"])


def test_fresh_checkpoint_neither_doubles_nor_overwrites(spark, landing):
    """The file_stats rows say which files are done, whatever the checkpoint knows."""
    cfg = RunConfig.load(os.path.join(FIXTURES, "config.yml"))
    drugs = next(t for t in cfg.tables if t.name == "drugs")
    out = tempfile.mkdtemp(prefix="sluice-stream-out-")

    def go(ckpt=None):
        ckpt = ckpt or tempfile.mkdtemp(prefix="sluice-stream-ckpt-")
        table_stream(spark, drugs, landing.root, out, cfg, checkpoint=ckpt).awaitTermination(120)
        valid = spark.read.parquet(os.path.join(out, "raw", "drugs"))
        reports = [spark.read.parquet(os.path.join(out, "data_quality", n)).count() for n in ("file_stats", "rows_stats", "data_invalid")]
        return sorted(r.atcode for r in valid.collect()), reports

    landing("drugs/drugs_1.csv", "atccode;drug\nA;1\nB;\n")
    landing("drugs/drugs_2.csv", "atccode;drug\nC;1\n")
    assert go() == (["A", "C"], [2, 2, 1])
    assert go() == (["A", "C"], [2, 2, 1])
    landing("drugs/drugs_3.csv", "atccode;drug\nD;1\nE;\n")
    assert go() == (["A", "C", "D"], [3, 3, 2])
    assert go() == (["A", "C", "D"], [3, 3, 2])


def test_batch_cut_off_before_its_last_report_is_written_again(spark, landing, monkeypatch):
    import sluice.streaming.landing as stream

    cfg = RunConfig.load(os.path.join(FIXTURES, "config.yml"))
    drugs = next(t for t in cfg.tables if t.name == "drugs")
    out, ckpt = tempfile.mkdtemp(prefix="sluice-stream-out-"), tempfile.mkdtemp(prefix="sluice-stream-ckpt-")
    landing("drugs/drugs_1.csv", "atccode;drug\nA;1\nB;\n")
    write = stream._write_batch

    def killed(df, path, *args, **kw):
        if path.endswith("file_stats"):
            raise RuntimeError("killed")
        write(df, path, *args, **kw)

    monkeypatch.setattr(stream, "_write_batch", killed)
    with pytest.raises(Exception, match="killed"):
        table_stream(spark, drugs, landing.root, out, cfg, checkpoint=ckpt).awaitTermination(120)
    monkeypatch.setattr(stream, "_write_batch", write)
    table_stream(spark, drugs, landing.root, out, cfg, checkpoint=ckpt).awaitTermination(120)
    assert [r.atcode for r in spark.read.parquet(os.path.join(out, "raw", "drugs")).collect()] == ["A"]
    assert [spark.read.parquet(os.path.join(out, "data_quality", n)).count() for n in ("file_stats", "rows_stats", "data_invalid")] == [1, 1, 1]
