"""Workbook landing files (S4) next to CSV files of the same table."""

import dataclasses

from conftest import rules
from xlsx import xlsx_bytes

from sluice.plans.landing import check_landing
from sluice.sources.workbook import read_sheet

TS = "2024-01-01 00:00:00"


def test_read_sheet_types_and_options():
    data = xlsx_bytes({
        "notes": [["x"]],
        "data": [["title row", None], ["id", "n", "when"], [1, 2.5, ("date", 43831)], [None, None, None], ["b", "NA", None]],
    })
    rows = read_sheet(data, "data", None, 1)
    assert rows[0] == ["id", "n", "when"]
    assert rows[1] == ["1", "2.5", "2020-01-01 00:00:00"]
    assert rows[2] == [None, None, None]
    assert read_sheet(data, "data", "A:A", 1) == [["id"], ["1"], [None], ["b"]]
    assert read_sheet(data, "data", ["when", "id"], 1) == [["id", "when"], ["1", "2020-01-01 00:00:00"], [None, None], ["b", None]]
    assert read_sheet(data, "data", [0, 2], 1) == [["id", "when"], ["1", "2020-01-01 00:00:00"], [None, None], ["b", None]]


def test_workbook_landing(spark, landing):
    r = dataclasses.replace(rules("pubmed"), formats={
        "csv": {"separator": ";", "encoding": "utf-8"},
        "xlsx": {"sheet_name": "data", "data_from_rows": 1},
    })
    landing("pubmed/pubmed_a.xlsx", xlsx_bytes({"data": [
        ["exported"], ["id", "title", "date", "journal"],
        [1, "t1", "01/01/2020", "j"], [1, "t2", "1/2/2020", "j"], [None, None, None, None], [3, None, "x", "j"],
    ]}), binary=True)
    landing("pubmed/pubmed_bad.xlsx", xlsx_bytes({"data": [["exported"], ["id", "title"], [1, "t"]]}), binary=True)
    landing("pubmed/pubmed_nosheet.xlsx", xlsx_bytes({"other": [["id"]]}), binary=True)
    landing("pubmed/pubmed_broken.xlsx", b"not a zip", binary=True)
    landing("pubmed/pubmed.csv", "id;title;date;journal\n9;t;01/01/2020;j\n")
    res = check_landing(spark, landing.root, r, table="pubmed", ingest_ts=TS)
    fs = {x.source_filename.split("/")[-1]: (x.is_invalid, x.description) for x in res.file_stats.collect()}
    assert fs["pubmed_a.xlsx"] == (False, "File is VALID")
    assert fs["pubmed_bad.xlsx"] == (True, "Columns do not respect the columns definition")
    assert fs["pubmed_nosheet.xlsx"][0] and fs["pubmed_nosheet.xlsx"][1].startswith("Error when reading the Excel file : ")
    assert fs["pubmed_broken.xlsx"][0]
    assert fs["pubmed.csv"] == (False, "File is VALID")
    inv = sorted((x.source_filename.split("/")[-1], x["index"], x.invalid_code) for x in res.data_invalid.collect())
    assert inv == [
        ("pubmed_a.xlsx", 0, "KEY_NOT_UNIQUE"), ("pubmed_a.xlsx", 1, "KEY_NOT_UNIQUE"),
        ("pubmed_a.xlsx", 3, "COLUMN_NOT_PARSABLE"), ("pubmed_a.xlsx", 3, "NULL_VALUE_NOT_EXPECTED"),
    ]
    assert sorted(x.id for x in res.valid.collect()) == [9]
    res.release()
