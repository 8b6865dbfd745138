"""Workbook landing scan (S4): .xlsx / .xlsm sheets read as text.

Spark has no workbook reader, so each file's bytes (``binaryFile``) go to a
``mapInPandas`` task that opens the zip and reads one sheet's XML with the
standard library: the sheet named in the rules (or the first), the column
subset ``data_columns`` (e.g. ``"A:D"`` or a list of positions), the rows to
skip ``data_from_rows`` (a count or a list of 0-based rows), first row kept
as header, every value as text. Files are independent, one task per batch of
files; the rows are handed back to Spark for the same checks as CSV.
"""

from __future__ import annotations

import io
import re
import zipfile
from dataclasses import dataclass
from datetime import datetime, timedelta
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import na_to_null
from ..rules import TableRules
from .listing import FILE_ID, PATH, file_id, inputs, relative_name

NS = {
    "m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
    "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
    "rel": "http://schemas.openxmlformats.org/package/2006/relationships",
}
# --- fixed values: built-in number formats that are dates (ECMA-376 18.8.30)
DATE_FORMAT_IDS = frozenset(range(14, 23)) | frozenset(range(45, 48))
EXCEL_EPOCH = datetime(1899, 12, 30)
# --------------------------------------------------------------------------

OUT_SCHEMA = (
    "_path string, _file_id long, kind string, index long, ok boolean, error string, "
    "header array<string>, cells array<string>"
)


def col_number(ref: str) -> int:
    """'A' -> 0, 'AB' -> 27 (from a cell reference like AB12)."""
    n = 0
    for ch in re.match(r"[A-Z]+", ref).group(0):
        n = n * 26 + ord(ch) - 64
    return n - 1


def parse_usecols(spec) -> set[int] | None:
    """Column positions from 'A:D,F' or a list of positions; None for all
    columns (and for a list of header names, applied after reading)."""
    if spec is None or (isinstance(spec, (list, tuple)) and spec and all(isinstance(x, str) for x in spec)):
        return None
    if isinstance(spec, str):
        out: set[int] = set()
        for part in spec.replace(" ", "").split(","):
            a, _, b = part.partition(":")
            lo, hi = col_number(a), col_number(b or a)
            out.update(range(lo, hi + 1))
        return out
    return {int(x) for x in spec}


def _text(v: str, kind: str | None, style: int, shared: list[str], date_styles: set[int]) -> str:
    if kind == "s":
        return shared[int(v)]
    if kind == "b":
        return "True" if v == "1" else "False"
    if kind in ("str", "inlineStr", "e"):
        return v
    num = float(v)
    if style in date_styles:
        return str(EXCEL_EPOCH + timedelta(days=num))
    return str(int(num)) if num.is_integer() and "E" not in v.upper() else repr(num)


def read_sheet(data: bytes, sheet_name=None, usecols=None, skiprows=None) -> list[list[str | None]]:
    """Rows of one sheet as lists of text (None for empty cells)."""
    z = zipfile.ZipFile(io.BytesIO(data))
    names = set(z.namelist())
    shared = []
    if "xl/sharedStrings.xml" in names:
        for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", NS):
            shared.append("".join(t.text or "" for t in si.iter(f"{{{NS['m']}}}t")))
    date_styles: set[int] = set()
    if "xl/styles.xml" in names:
        st = ET.fromstring(z.read("xl/styles.xml"))
        custom = {
            int(f.get("numFmtId")): f.get("formatCode", "")
            for f in st.findall("m:numFmts/m:numFmt", NS)
        }
        for i, xf in enumerate(st.findall("m:cellXfs/m:xf", NS)):
            fid = int(xf.get("numFmtId", "0"))
            code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", custom.get(fid, ""))
            if fid in DATE_FORMAT_IDS or (fid in custom and re.search(r"[dmyhs]", code, re.I)):
                date_styles.add(i)
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheets = wb.findall("m:sheets/m:sheet", NS)
    if isinstance(sheet_name, int):
        sheet = sheets[sheet_name]
    elif sheet_name:
        matches = [s for s in sheets if s.get("name") == sheet_name]
        if not matches:
            raise ValueError(f"Worksheet named '{sheet_name}' not found")
        sheet = matches[0]
    else:
        sheet = sheets[0]
    rid = sheet.get(f"{{{NS['r']}}}id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels.findall("rel:Relationship", NS) if r.get("Id") == rid)
    path = target.lstrip("/") if target.startswith("/") else "xl/" + target
    root = ET.fromstring(z.read(path))
    keep = parse_usecols(usecols)
    grid: dict[int, dict[int, str]] = {}
    for row in root.findall("m:sheetData/m:row", NS):
        r = int(row.get("r")) - 1
        cells = grid.setdefault(r, {})
        for c in row.findall("m:c", NS):
            ci = col_number(c.get("r"))
            if keep is not None and ci not in keep:
                continue
            kind = c.get("t")
            if kind == "inlineStr":
                v = "".join(t.text or "" for t in c.iter(f"{{{NS['m']}}}t"))
            else:
                vnode = c.find("m:v", NS)
                if vnode is None or vnode.text is None:
                    continue
                v = vnode.text
            cells[ci] = _text(v, kind, int(c.get("s", "0")), shared, date_styles)
    if not grid:
        return []
    cols = sorted(keep) if keep is not None else list(range(max((max(c) for c in grid.values() if c), default=-1) + 1))
    skip = set(range(skiprows)) if isinstance(skiprows, int) else set(skiprows or [])
    rows = [[grid.get(r, {}).get(c) for c in cols] for r in range(max(grid) + 1) if r not in skip]
    while rows and all(v is None for v in rows[-1]):
        rows.pop()
    # Columns with no header and no value at all are not part of the sheet.
    width = max((i + 1 for row in rows for i, v in enumerate(row) if v is not None), default=0)
    rows = [row[:width] for row in rows]
    if rows and isinstance(usecols, (list, tuple)) and usecols and all(isinstance(x, str) for x in usecols):
        # usecols as header names: keep those columns, in sheet order
        keep_idx = [i for i, h in enumerate(rows[0]) if h in set(usecols)]
        rows = [[row[i] if i < len(row) else None for i in keep_idx] for row in rows]
    return rows


def _scan_batches(opts: dict):
    def run(batches):
        for pdf in batches:
            out = []
            for path, fid, content in zip(pdf["path"], pdf["_file_id"], pdf["content"]):
                try:
                    rows = read_sheet(
                        bytes(content), opts.get("sheet_name"), opts.get("data_columns"),
                        opts.get("data_from_rows"),
                    )
                except Exception as e:  # unreadable workbook: reported per file
                    out.append((path, fid, "file", None, False, f"{type(e).__name__}: {e}", None, None))
                    continue
                header = ["" if v is None else v for v in rows[0]] if rows else []
                out.append((path, fid, "file", None, True, None, header, None))
                for i, row in enumerate(rows[1:]):
                    out.append((path, fid, "row", i, None, None, None, row))
            yield pd.DataFrame(
                out, columns=["_path", "_file_id", "kind", "index", "ok", "error", "header", "cells"]
            )

    return run


@dataclass
class WorkbookScan:
    rows: DataFrame
    facts: DataFrame
    cached: list


def scan_workbooks(
    spark: SparkSession,
    root: str,
    rules: TableRules,
    paths: list[str] | None = None,
    seed: int = 0,
) -> WorkbookScan:
    opts = rules.format_options("xlsx") or rules.format_options("xlsm")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.xls[xm]")
        .load(inputs(root, rules.source_path, paths))
        .select("path", "content", file_id(F.col("_metadata.file_path"), seed).alias(FILE_ID))
    )
    parsed = files.mapInPandas(_scan_batches(opts), OUT_SCHEMA).persist(StorageLevel.MEMORY_AND_DISK)
    expected = F.array(*[F.lit(h) for h in rules.header])
    facts = parsed.where(F.col("kind") == "file").select(
        PATH,
        F.col("ok").alias("parse_ok"),
        "error",
        (F.coalesce(F.col("header") == expected, F.lit(False)) & F.lit(rules.header_matchable)).alias(
            "header_ok"
        ),
    )
    data = rules.data_columns
    rows = parsed.where(F.col("kind") == "row").select(
        FILE_ID,
        relative_name(F.col(PATH), root).alias("source_filename"),
        F.col("index"),
        *[na_to_null(F.try_element_at("cells", F.lit(i + 1))).alias(c.name) for i, c in enumerate(data)],
    )
    return WorkbookScan(rows=rows, facts=facts, cached=[parsed])
