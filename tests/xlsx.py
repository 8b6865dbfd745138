"""Minimal .xlsx writer for test fixtures (shared strings, numbers, a date style)."""

import io
import zipfile
from xml.sax.saxutils import escape

CT = """<?xml version="1.0" encoding="UTF-8"?>
<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">
<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>
<Default Extension="xml" ContentType="application/xml"/>
<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>
</Types>"""
RELS = """<?xml version="1.0" encoding="UTF-8"?>
<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">
<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>
</Relationships>"""
STYLES = """<?xml version="1.0" encoding="UTF-8"?>
<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">
<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>"""


def col_letter(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def xlsx_bytes(sheets: dict[str, list[list]]) -> bytes:
    """sheets: name -> rows; a cell is str, int/float, ('date', serial) or None."""
    shared: list[str] = []
    buf = io.BytesIO()
    z = zipfile.ZipFile(buf, "w")
    z.writestr("[Content_Types].xml", CT)
    z.writestr("_rels/.rels", RELS)
    wb = ['<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
          'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>']
    rels = ['<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">']
    for n, (name, rows) in enumerate(sheets.items(), start=1):
        wb.append(f'<sheet name="{escape(name)}" sheetId="{n}" r:id="rId{n}"/>')
        rels.append(f'<Relationship Id="rId{n}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{n}.xml"/>')
        xml = ['<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>']
        for r, row in enumerate(rows, start=1):
            xml.append(f'<row r="{r}">')
            for c, v in enumerate(row):
                ref = f"{col_letter(c)}{r}"
                if v is None:
                    continue
                if isinstance(v, tuple):
                    xml.append(f'<c r="{ref}" s="1"><v>{v[1]}</v></c>')
                elif isinstance(v, str):
                    shared.append(v)
                    xml.append(f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>')
                else:
                    xml.append(f'<c r="{ref}"><v>{v}</v></c>')
            xml.append("</row>")
        xml.append("</sheetData></worksheet>")
        z.writestr(f"xl/worksheets/sheet{n}.xml", "".join(xml))
    wb.append("</sheets></workbook>")
    rels.append("</Relationships>")
    z.writestr("xl/workbook.xml", "".join(wb))
    z.writestr("xl/_rels/workbook.xml.rels", "".join(rels))
    z.writestr("xl/styles.xml", STYLES)
    sst = ['<?xml version="1.0" encoding="UTF-8"?><sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">']
    sst += [f"<si><t>{escape(s)}</t></si>" for s in shared]
    sst.append("</sst>")
    z.writestr("xl/sharedStrings.xml", "".join(sst))
    z.close()
    return buf.getvalue()
