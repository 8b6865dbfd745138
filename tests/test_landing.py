"""Landing files end to end (S1-S3, F1-F4, I1, A6): the landing cases of FIXTURES.md."""

import pytest
from conftest import rules

from sluice.plans.landing import check_landing

TS = "2024-01-01 00:00:00"
H = "id;scientific_title;date;journal\n"
FILE_OK = "File is VALID"
BAD_COLS = "Columns do not respect the columns definition"


def run(spark, landing, name="clinical_trials", **kw):
    return check_landing(spark, landing.root, rules(name), table=name, ingest_ts=TS, **kw)


def stats(res):
    return {r.source_filename.split("/")[-1]: (r.is_invalid, r.description) for r in res.file_stats.collect()}


def rows_by_file(res):
    return {r.source_filename.split("/")[-1]: r for r in res.rows_stats.collect()}


def test_file_cases(spark, landing):
    w = landing
    w("clinical_trials/clinical_trials_clean.csv", H + "A1;t1;1 January 2020;j1\nA2;t2;2 February 2020;j2\n")
    w("clinical_trials/clinical_trials_empty.csv", "")
    w("clinical_trials/clinical_trials_nl.csv", "\n")
    w("clinical_trials/clinical_trials_hdr.csv", H)
    w("clinical_trials/clinical_trials_order.csv", "journal;id;scientific_title;date\nj;1;t;1 January 2020\n")
    w("clinical_trials/clinical_trials_dup.csv", "id;id;date;journal\n1;2;3;4\n")
    w("clinical_trials/clinical_trials_emptyhdr.csv", "id;scientific_title;date;\n1;2;3;4\n")
    w("clinical_trials/clinical_trials_widehdr.csv", "id;scientific_title;date;journal;\n1;2;3;4;\n")
    w("clinical_trials/clinical_trials_x.txt", H)
    w("clinical_trials/clinical_trials_long.csv", H + "1;t;1 January 2020;j\n2;t;1 January 2020;j;\n")
    w("clinical_trials/clinical_trials_long2.csv", H + "1;t;1 January 2020;j\n2;t;x;j;;\n")
    w("clinical_trials/clinical_trials_short.csv", H + "1;t;1 January 2020\n")
    w("clinical_trials/clinical_trials_openq.csv", H + '1;t;1 January 2020;"j\n2;t;x;j\n')
    w("clinical_trials/clinical_trials_badutf.csv", (H + "1;t;1 January 2020;j").encode() + b"\xff\n", binary=True)
    w("clinical_trials/clinical_trials_stray.csv", H + '5" pipe;t;1 January 2020;j\n')
    w("clinical_trials/clinical_trials_bom.csv",
      "﻿" + H.replace("\n", "\r\n") + '1;"a;b";1 January 2020;"multi\nline"\r\n')
    w("other/clinical_trials_elsewhere.csv", H)  # outside the prefix
    res = run(spark, landing)
    s = stats(res)
    assert "clinical_trials_empty.csv" not in s and "clinical_trials_elsewhere.csv" not in s
    assert s["clinical_trials_clean.csv"] == (False, FILE_OK)
    assert s["clinical_trials_hdr.csv"] == (False, FILE_OK)
    assert s["clinical_trials_stray.csv"] == (False, FILE_OK)
    assert s["clinical_trials_bom.csv"] == (False, FILE_OK)
    assert s["clinical_trials_short.csv"] == (False, FILE_OK)
    for f in ("order", "dup", "emptyhdr", "widehdr"):
        assert s[f"clinical_trials_{f}.csv"] == (True, BAD_COLS), f
    assert s["clinical_trials_x.txt"] == (True, BAD_COLS)
    for f in ("nl", "long", "long2", "openq", "badutf"):
        inv, desc = s[f"clinical_trials_{f}.csv"]
        assert inv and desc.startswith("Error when reading the CSV file : "), f
    by = rows_by_file(res)
    # A6: header-only file gets a zero row; invalid files get none.
    assert by["clinical_trials_hdr.csv"].nb_valid_lines == 0
    assert by["clinical_trials_clean.csv"].nb_valid_lines == 2
    assert "clinical_trials_long.csv" not in by
    assert by["clinical_trials_short.csv"].nb_invalid_lines_NULL_VALUE_NOT_EXPECTED == 1
    valid = {(r.id, r.scientific_title, r.journal) for r in res.valid.collect()}
    assert ("1", "a;b", "multi line") in valid and ('5" pipe', "t", "j") in valid
    assert res.file_stats.columns == [
        "pipeline", "dataset", "table", "source_filename", "date_ingest", "is_invalid", "description"
    ]
    res.release()


def test_ordinals_skip_blank_lines_count_all_null_rows(spark, landing):
    landing("drugs/drugs.csv", "atccode;drug\n\nA;1\n\n   \n\t\n;\nB;2\n\"C\";\"multi\nline\"\nC;3\n")
    res = run(spark, landing, "drugs")
    inv = sorted((r["index"], r.invalid_code) for r in res.data_invalid.collect())
    # A=0, ';' (all null, dropped)=1, B=2, C=3, C=4 (key duplicate of 3)
    assert inv == [(3, "KEY_NOT_UNIQUE"), (4, "KEY_NOT_UNIQUE")]
    assert res.rows_stats.collect()[0].nb_valid_lines == 2


def test_na_tokens(spark, landing):
    landing("drugs/drugs.csv", "atccode;drug\nNA;x\nnull;y\nNone;z\nn/a;w\nnone;a\nNull;b\n-;c\n")
    res = run(spark, landing, "drugs")
    nulls = sorted(r["index"] for r in res.data_invalid.collect() if r.invalid_code == "NULL_VALUE_NOT_EXPECTED")
    assert nulls == [0, 1, 2, 3]
    assert sorted(r.atcode for r in res.valid.collect()) == ["-", "Null", "none"]


def test_key_scope_per_file(spark, landing):
    landing("drugs/drugs_a.csv", "atccode;drug\nK;1\n")
    landing("drugs/drugs_b.csv", "atccode;drug\nK;1\n")
    res = run(spark, landing, "drugs")
    assert res.data_invalid.count() == 0 and res.valid.count() == 2


def test_json_files(spark, landing):
    landing("clinical_trials/clinical_trials.json",
            '[{"id":"J1","scientific_title":"t","date":"1 January 2020","journal":"j"},'
            '{"id":"J2","scientific_title":"t","date":"2 January 2020","journal":null}]')
    landing("clinical_trials/clinical_trials_order.json",
            '[{"scientific_title":"t","id":"J1","date":"1 January 2020","journal":"j"}]')
    landing("clinical_trials/clinical_trials_broken.json", '[{"id":1},')
    res = run(spark, landing)
    s = stats(res)
    assert s["clinical_trials.json"] == (False, FILE_OK)
    assert s["clinical_trials_order.json"] == (True, BAD_COLS)
    assert s["clinical_trials_broken.json"][0]
    inv = [(r["index"], r.invalid_code) for r in res.data_invalid.collect()]
    assert inv == [(1, "NULL_VALUE_NOT_EXPECTED")]
    assert [r.id for r in res.valid.collect()] == ["J1"]


@pytest.mark.parametrize("multi_line", [True, False])
def test_ordinals_do_not_depend_on_splits(spark, landing, multi_line):
    """I1 invariant: several scan blocks per file give the same ordinals."""
    n = 4000
    body = "".join(f"K{i % 1500};drug {i}\n" + ("\n" if i % 97 == 0 else "") for i in range(n))
    landing("drugs/drugs_big.csv", "atccode;drug\n" + body)
    landing("drugs/drugs_small.csv", "atccode;drug\nK1;x\nK1;y\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        res = run(spark, landing, "drugs", multi_line=multi_line)
        got = sorted((r.source_filename.split("/")[-1], r["index"]) for r in res.data_invalid.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    # Brute force: K{i%1500} is duplicated iff another i' with the same residue exists.
    counts = {}
    for i in range(n):
        counts[i % 1500] = counts.get(i % 1500, 0) + 1
    want = sorted([("drugs_big.csv", i) for i in range(n) if counts[i % 1500] > 1]
                  + [("drugs_small.csv", 0), ("drugs_small.csv", 1)])
    assert got == want


def test_stage_mode_same_outputs_and_cleanup(spark, landing):
    import os

    landing("drugs/drugs.csv", "atccode;drug\nA;1\nA;2\nB;\n;\nC;3\n")
    outs = {}
    for how in ("persist", "stage", "none"):
        res = run(spark, landing, "drugs", materialize_as=how)
        outs[how] = (
            sorted(map(tuple, res.data_invalid.drop("date_ingest").collect())),
            sorted(map(tuple, res.rows_stats.drop("date_ingest").collect())),
            sorted(map(tuple, res.valid.drop("execution_datetime").collect())),
        )
        staged = list(res.staged)
        assert (how == "stage") == bool(staged)
        res.release()
        for p in staged:
            assert not os.path.exists(p.replace("file:", ""))
    assert outs["persist"] == outs["stage"] == outs["none"]


@pytest.mark.parametrize("multi_line", [True, False])
def test_uncached_scan_gives_same_ordinals(spark, landing, multi_line):
    body = "".join(f"K{i % 700};d{i}\n" + ("\n" if i % 31 == 0 else "") for i in range(3000))
    landing("drugs/drugs_big.csv", "atccode;drug\n" + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = []
        for cache_scan in (True, False):
            res = run(spark, landing, "drugs", multi_line=multi_line, cache_scan=cache_scan)
            got.append(sorted((r["index"], r.invalid_col_value) for r in res.data_invalid.collect()))
            res.release()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got[0] == got[1] and len(got[0]) == 3000


def test_nothing_landed(spark, landing):
    res = run(spark, landing, "drugs")
    assert res.file_stats.count() == 0 and res.rows_stats.count() == 0
    assert res.data_invalid.count() == 0 and res.valid.count() == 0


def test_skewed_scan_is_detected(spark, landing):
    from sluice.plans.landing import skewed_blocks

    blocks = spark.createDataFrame([("a", 0, 1000), ("b", 0, 10), ("c", 0, 12)], "_path string, _block long, _n long")
    assert skewed_blocks(blocks, 8)
    even = spark.createDataFrame([(f"f{i}", 0, 100) for i in range(16)], "_path string, _block long, _n long")
    assert not skewed_blocks(even, 8)


def test_utf8_bytes_check(spark, landing):
    landing("drugs/drugs_fffd.csv", "atccode;drug\nA;x�y\n")  # valid UTF-8 holding U+FFFD
    landing("drugs/drugs_bad.csv", b"atccode;drug\nA;x\xffy\n", binary=True)
    got = stats(run(spark, landing, "drugs"))
    assert got["drugs_bad.csv"][0]
    assert got["drugs_fffd.csv"] == (False, FILE_OK)


def test_repeated_expected_header_never_matches(spark, landing):
    import dataclasses

    from sluice.rules import ColumnRule

    r = rules("drugs")
    cols = (ColumnRule("a1", "STRING", "a"), ColumnRule("a2", "STRING", "a"), *r.columns[-2:])
    rr = dataclasses.replace(r, columns=cols)
    landing("drugs/drugs.csv", "a;a\n1;2\n")
    res = check_landing(spark, landing.root, rr, table="drugs", ingest_ts=TS)
    assert stats(res)["drugs.csv"] == (True, BAD_COLS)


@pytest.mark.parametrize("multi_line", [True, False])
def test_latin1_encoding(spark, landing, multi_line):
    import dataclasses

    r = rules("drugs")
    r = dataclasses.replace(r, formats={"csv": {"separator": ";", "encoding": "latin-1"}})
    landing("drugs/drugs.csv", "atccode;drug\nA;café\nB;naïve\n".encode("latin-1"), binary=True)
    res = check_landing(spark, landing.root, r, table="drugs", ingest_ts=TS, multi_line=multi_line)
    assert stats(res)["drugs.csv"] == (False, FILE_OK)
    assert sorted(x.drug for x in res.valid.collect()) == ["café", "naïve"]


def test_same_results_when_nothing_may_be_broadcast(spark, landing):
    """Over-budget branches (shuffle joins everywhere) give the same outputs."""
    landing("drugs/drugs_a.csv", "atccode;drug\nA;1\nA;2\n;\nB;\n")
    landing("drugs/drugs_b.csv", "atccode;drug\nA;1\nC;3\nC;4\n")
    landing("drugs/drugs_c.json", '[{"atccode":"J","drug":"x"},{"atccode":"J","drug":null}]')
    landing("drugs/drugs_d.csv", "drug;atccode\nx;y\n")

    def outputs():
        res = run(spark, landing, "drugs")
        out = (
            sorted(map(tuple, res.file_stats.drop("date_ingest").collect())),
            sorted(map(tuple, res.rows_stats.drop("date_ingest").collect())),
            sorted(map(tuple, res.data_invalid.drop("date_ingest").collect()), key=str),
            sorted(map(tuple, res.valid.drop("execution_datetime").collect()), key=str),
        )
        res.release()
        return out

    default = outputs()
    spark.conf.set("sluice.broadcast.maxBytes", "1")
    try:
        tiny = outputs()
    finally:
        spark.conf.unset("sluice.broadcast.maxBytes")
    assert default == tiny
    assert len(default[2]) == 8  # a: key A x2 + null drug; b: key C x2; c: key J x2 + null


def test_line_mode_refuses_quoted_newlines(spark, landing):
    """Line mode on a file with a quoted newline reports the file unreadable
    (an open quote on a line) instead of splitting the record silently."""
    landing("drugs/drugs.csv", 'atccode;drug\nA;"two\nlines"\nB;ok\n')
    inv, desc = stats(run(spark, landing, "drugs", multi_line=False))["drugs.csv"]
    assert inv and desc.startswith("Error when reading the CSV file : ")
    assert stats(run(spark, landing, "drugs", multi_line=True))["drugs.csv"] == (False, FILE_OK)


def test_each_file_is_read_in_the_mode_it_needs(spark, landing):
    """Quoted newlines in one file do not keep the others from being split."""
    from sluice.sources.csv import scan_csv_files

    body = "".join(f"K{i};drug {i}\n" for i in range(3000))
    landing("drugs/drugs_big.csv", "atccode;drug\n" + body)
    landing("drugs/drugs_quoted.csv", 'atccode;drug\nA;"two\nlines"\nA;"x;y"\n')
    landing("drugs/drugs_open.csv", 'atccode;drug\nA;"never closed\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines, records = scan_csv_files(spark, landing.root, rules("drugs"))
        sizes = {r.source_filename: r["count"] for r in lines.blocks.groupBy("source_filename").count().collect()}
        assert sizes["drugs/drugs_big.csv"] > 5
        # the unreadable file has facts, its records are not built
        assert records.facts.count() == 2
        assert [r[0] for r in records.rows.select("source_filename").distinct().collect()] == ["drugs/drugs_quoted.csv"]
        for df in lines.cached + records.cached:
            df.unpersist()
        got = []
        for multi_line in (None, True):
            res = run(spark, landing, "drugs", multi_line=multi_line)
            s = stats(res)
            assert s["drugs_open.csv"][0] and not s["drugs_quoted.csv"][0] and not s["drugs_big.csv"][0]
            got.append((sorted(map(tuple, res.data_invalid.collect())), sorted(map(tuple, res.valid.drop("execution_datetime").collect())), s))
            res.release()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got[0] == got[1]
    assert len(got[0][0]) == 2 and len(got[0][1]) == 3000


def test_blocks_are_broadcast_up_to_64_bytes_each(spark, landing):
    """A million blocks take 64 MB: the rows meet no shuffle on their way to the checks."""
    from sluice.sources.csv import BLOCK_BYTES, scan_csv

    landing("drugs/drugs_big.csv", "atccode;drug\n" + "".join(f"K{i};drug {i}\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    joined = {}
    try:
        for spare in (0, -1):
            blocks = scan_csv(spark, landing.root, rules("drugs"), multi_line=False).nblocks
            assert blocks > 8
            spark.conf.set("sluice.broadcast.maxBytes", str(BLOCK_BYTES * blocks + spare))
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            scan = scan_csv(spark, landing.root, rules("drugs"), multi_line=False)
            plan = scan.rows._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
            joined[spare] = "SortMergeJoin" in plan
            assert sorted(r["index"] for r in scan.rows.collect()) == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("sluice.broadcast.maxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined == {0: False, -1: True}


@pytest.mark.parametrize("names, options", [(1000, {}), (0, {"spark.sql.autoBroadcastJoinThreshold": "-1", "sluice.broadcast.maxBytes": "1"})])
def test_quoted_newlines_are_split(spark, landing, monkeypatch, names, options):
    """Files whose values hold newlines, quotes and separators: the same outputs from many
    small blocks as from one task a file, and more tasks than files."""
    import random

    from sluice.sources import csv

    monkeypatch.setattr(csv, "NAMES", names)
    spark.catalog.clearCache()
    r = random.Random(9)
    texts = [
        lambda: f"plain {r.randint(0, 9)}", lambda: '"a\nb"', lambda: '"x;""y""\n\n;z"', lambda: '5" pipe', lambda: '"q" tail "n"', lambda: '"' + "long line\n" * 80 + '"',
        lambda: '"\n"', lambda: '"""\n"""', lambda: "",
    ]
    for k in range(4):
        body = "".join(f"K{r.randint(0, 60)};{r.choice(texts)()}\n" + ("  \n" if r.random() < 0.1 else "") for _ in range(120))
        landing(f"drugs/drugs_{k}.csv", ("\n" if k else "\ufeff") + "atccode;drug\n" + body + ('A;"open\n' + "more\n" * 50 if k == 3 else ""))
    landing("drugs/drugs_wide.csv", 'atccode;drug\nA;"b\nc"\nA;"b\nc";d\n')
    landing("drugs/drugs_plain.csv", "atccode;drug\nA;b\n")
    landing("drugs/drugs_bytes.csv", 'atccode;drug\nA;"b\n'.encode() + b'\xff"\nB;c\n', binary=True)
    options = {"spark.sql.files.maxPartitionBytes": "1024", "spark.sql.files.openCostInBytes": "1", **options}
    old = {k: spark.conf.get(k, None) for k in options}
    got = []
    try:
        for multi_line in (None, True):
            res = run(spark, landing, "drugs", multi_line=multi_line, cache_scan=names > 0)
            got.append((stats(res), sorted(map(str, res.data_invalid.collect())), sorted(map(str, res.valid.collect())), sorted(map(str, res.rows_stats.collect()))))
            res.release()
            for k, v in options.items():
                spark.conf.set(k, v)
            if multi_line is None:
                scans = csv.scan_csv_files(spark, landing.root, rules("drugs"))
                assert len(scans) == 2 and scans[1].nblocks > 6
                for scan in scans:
                    for df in scan.cached:
                        df.unpersist()
        res = run(spark, landing, "drugs", cache_scan=names > 0)
        got.append((stats(res), sorted(map(str, res.data_invalid.collect())), sorted(map(str, res.valid.collect())), sorted(map(str, res.rows_stats.collect()))))
        res.release()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert got[0] == got[1] == got[2]
    assert [got[0][0][f"drugs_{x}.csv"][0] for x in (0, 1, 2, 3, "wide", "plain", "bytes")] == [False, False, False, True, True, False, True]
    assert len(got[0][1]) > 100


def test_quote_states_against_a_reader_of_single_characters():
    """Line codes, folded blocks and assembled records against a walk over every character."""
    import random

    import numpy as np
    import pyarrow as pa

    from sluice.sources import records as rec

    def walk(text, state):  # 0 field start, 1 in field, 2 in quotes, 3 after a quote in quotes
        for c in text:
            if state == 2:
                state = 3 if c == '"' else 2
            elif c in ";\n":
                state = 0
            elif c == '"' and state in (0, 3):
                state = 2
            else:
                state = 1
        return 2 if state == 2 else 0

    r = random.Random(1)
    for _ in range(300):
        lines = ["".join(r.choices('";ab ', k=r.randint(0, 6))) for _ in range(r.randint(1, 30))]
        code = np.array([(walk(x, 0) == 2) * rec.ENDS_IN + (walk(x, 2) == 2) * rec.STAYS_IN + (not x.strip()) * rec.BLANK for x in lines], np.int32)
        states, state = [], 0
        for x in lines:
            states.append(state // 2)
            state = walk(x, state)
        assert rec.line_states(code, 0).tolist() == [*states, state // 2]
        blocks = sorted(r.randint(0, 5) for _ in lines)
        ids = pa.array([7] * len(lines), pa.int64())
        batch = lambda *cols: [pa.RecordBatch.from_arrays([ids, pa.array(blocks, pa.int64()), pa.array(["u"] * len(lines)), *cols], names=list("abcdefg")[:3 + len(cols)])]  # noqa: E731, B023
        cut = r.randint(0, len(lines))
        halves = lambda b: iter([b[0].slice(0, cut), b[0].slice(cut)])  # noqa: E731, B023
        folded = {x["block"]: x for b in rec.fold(halves(batch(pa.array(code)))) for x in b.to_pylist()}
        entry, offset, s, n = {}, {}, 0, 0
        for b in sorted(folded):
            entry[b], offset[b] = s == 1, n
            n, s = n + folded[b][("n_out", "n_kept")[s]], folded[b][("out", "kept")[s]]
        built = rec.assemble(halves(batch(pa.array(code), pa.array(lines), pa.array([entry[b] for b in blocks]), pa.array([offset[b] for b in blocks], pa.int64()))))
        pieces = {}
        for b in built:
            for x in b.to_pylist():
                pieces.setdefault(x["ordinal"], []).append((x["piece"] or 0, x["raw"]))
        want, now = [], None
        for x, inside in zip(lines, states):
            if inside:
                want[-1] += "\n" + x
            elif x.strip():
                want.append(x)
        assert ["\n".join(p for _, p in sorted(pieces[k])) for k in sorted(pieces)] == want
        assert sorted(pieces) == list(range(len(want)))


def _json_files(landing):
    """JSON documents, sound and broken, whose strings hold braces, brackets, quotes and backslashes."""
    import json
    import random

    r = random.Random(4)
    values = [None, 1, 1.50, True, "plain", "a}b{", '"quoted" \\ back', "\\", "]},{", "é\n", {"x": {"y": [1, "}"]}}, [1, [2, "]"]], "", "t" * 300]
    obj = lambda: {"atccode": f"K{r.randint(0, 9)}", "drug": r.choice(values)}
    docs = {f"ok{k}": json.dumps([obj() for _ in range(90)], ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1])) for k in range(4)}
    docs["doubled"] = '[{"atccode":"A","atccode":"B","drug":"x"}]'
    docs["order"] = json.dumps([{"drug": "x", "atccode": "A"}] * 20)
    docs["late"] = json.dumps([{"atccode": "A"}] * 30 + [{"atccode": "A", "drug": "b"}])
    docs["more"] = json.dumps([obj() for _ in range(20)] + [{"atccode": "A", "drug": "b", "extra": 1}])
    docs["empty"], docs["blank"], docs["object"], docs["numbers"] = "[]", " [ ] \n", '{"atccode":"A","drug":"b"}', "[1,2]"
    docs["cut"], docs["unclosed"] = docs["ok0"][:-40], docs["ok1"].rstrip()[:-1]
    docs["twice"], docs["tail"], docs["comma"] = docs["ok0"] + docs["ok1"], docs["ok1"] + " x", docs["ok0"].rstrip()[:-1] + ",]"
    docs["quote"] = docs["ok1"].replace('"drug"', '"drug', 1)
    docs["missing"] = docs["ok1"].replace("},", "} ", 1) if "}," in docs["ok1"] else docs["ok1"][1:]
    docs["single"] = "[{'atccode':'A','drug':'b'}]"
    for name, text in docs.items():
        landing(f"drugs/drugs_{name}.json", text)
    landing("drugs/drugs_bytes.json", b'[{"atccode":"\xff","drug":"b"}]', binary=True)


@pytest.mark.parametrize("options", [{}, {"spark.sql.autoBroadcastJoinThreshold": "-1", "sluice.broadcast.maxBytes": "1"}])
def test_json_files_are_split(spark, landing, options):
    """One JSON array read by many tasks: members, numbers and verdicts of the whole-document reading."""
    from sluice.sources.json import scan_split_json

    _json_files(landing)
    got = []
    options = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1", **options}
    old = {k: spark.conf.get(k, None) for k in options}
    try:
        for split in (False, True):
            res = run(spark, landing, "drugs", cache_scan=not options.get("sluice.broadcast.maxBytes"), json_split_bytes=0 if split else 1 << 26)
            got.append((stats(res), sorted(map(str, res.data_invalid.collect())), sorted(map(str, res.valid.collect())), sorted(map(str, res.rows_stats.collect()))))
            res.release()
            for k, v in options.items():
                spark.conf.set(k, v)
        scan = scan_split_json(spark, landing.root, rules("drugs"), split_bytes=0)
        assert scan.cached[0].where("uri LIKE '%ok0.json'").count() > 10
        for df in scan.cached:
            df.unpersist()
        res = run(spark, landing, "drugs", json_split_bytes=2000)  # some split, some whole
        got.append((stats(res), sorted(map(str, res.data_invalid.collect())), sorted(map(str, res.valid.collect())), sorted(map(str, res.rows_stats.collect()))))
        res.release()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert got[0] == got[1] == got[2]
    s = got[1][0]
    assert [n for n in sorted(s) if not s[n][0]] == ["drugs_doubled.json", "drugs_late.json"] + [f"drugs_ok{k}.json" for k in range(4)]
    assert s["drugs_order.json"] == s["drugs_more.json"] == s["drugs_empty.json"] == (True, BAD_COLS)
    assert len(got[0][2]) + len(got[0][1]) > 300


def test_hidden_names_are_listed(spark, landing):
    """Names, and names of folders, that begin with _ or . get a file_stats row at any depth."""
    text = "atccode;drug\nA;b\n"
    for name in ("drugs_a.csv", "drugs_d/_x.csv", "drugs_d/.x.csv", "drugs_d/b.csv", "drugs_d/e/f/_y.json", "drugs_d/_z/c.csv", "drugs_d/.w/q/d.csv", "_other.csv", "drugs_d/k=1/_v.csv"):
        landing(f"drugs/{name}", text)
    landing("drugs/drugs_d/_empty", "")
    res = run(spark, landing, "drugs")
    s = {r.source_filename[6:]: r.is_invalid for r in res.file_stats.collect()}
    hidden = {n for n, bad in s.items() if bad}
    assert hidden == {"drugs_d/_x.csv", "drugs_d/.x.csv", "drugs_d/e/f/_y.json", "drugs_d/_z/c.csv", "drugs_d/.w/q/d.csv", "drugs_d/k=1/_v.csv"}
    assert set(s) - hidden == {"drugs_a.csv", "drugs_d/b.csv"}
    res.release()
    from sluice.sources.listing import hidden_files

    assert [p.rsplit("/", 1)[1] for p, _ in hidden_files(spark, landing.root, "drugs/_o")] == ["_other.csv"]
    names = {p.split("/drugs/", 1)[1] for p, _ in hidden_files(spark, landing.root, "drugs/")}
    assert names == hidden | {"_other.csv"}


@pytest.mark.parametrize("names", [1000, 0])
def test_other_encodings_are_decoded_strictly(spark, landing, monkeypatch, names):
    """U+FFFD is a character in UTF-16; half a surrogate pair is not."""
    import dataclasses

    from sluice.sources import csv

    monkeypatch.setattr(csv, "NAMES", names)
    r = dataclasses.replace(rules("drugs"), formats={"csv": {"separator": ";", "encoding": "utf-16"}})
    good = "atccode;drug\nA;b\ufffdc\nB;\U0001f600\n"
    landing("drugs/drugs_good.csv", good.encode("utf-16"), binary=True)
    landing("drugs/drugs_plain.csv", "atccode;drug\nA;b\n".encode("utf-16"), binary=True)
    landing("drugs/drugs_pair.csv", good.encode("utf-16") + b"\x00\xd8A\x00", binary=True)
    res = check_landing(spark, landing.root, r, table="drugs", ingest_ts=TS)
    s = stats(res)
    assert not s["drugs_good.csv"][0] and not s["drugs_plain.csv"][0] and s["drugs_pair.csv"][0]
    assert sorted(x.drug for x in res.valid.collect()) == ["b", "b\ufffdc", "\U0001f600"]
    res.release()
