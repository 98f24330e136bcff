"""Minimal workbooks for round trips: shared and inline strings, numbers and dates."""

import datetime
import io
import zipfile
from xml.sax.saxutils import escape

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _letters(index):
    name = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        name = chr(65 + rest) + name
    return name


def workbook(rows, blank_rows=()):
    """Bytes of a workbook; `blank_rows` are row numbers left out of the sheet."""
    shared, lines, number = [], [], 0
    for row in rows:
        number += 1
        while number in blank_rows:
            number += 1
        cells = []
        for place, value in enumerate(row):
            ref = f'r="{_letters(place)}{number}"'
            if value is None:
                continue
            if isinstance(value, datetime.date):
                days = (value - datetime.date(1899, 12, 30)).days
                cells.append(f'<c {ref} s="1"><v>{days}</v></c>')
            elif isinstance(value, bool):
                cells.append(f'<c {ref} t="b"><v>{int(value)}</v></c>')
            elif isinstance(value, (int, float)):
                cells.append(f"<c {ref}><v>{value}</v></c>")
            elif place % 2:
                cells.append(f'<c {ref} t="inlineStr"><is><t>{escape(value)}</t></is></c>')
            else:
                shared.append(value)
                cells.append(f'<c {ref} t="s"><v>{len(shared) - 1}</v></c>')
        lines.append(f'<row r="{number}">{"".join(cells)}</row>')
    parts = {
        "xl/workbook.xml": f'<workbook {MAIN} xmlns:r="{RELS}"><sheets>'
        '<sheet name="Pay" sheetId="1" r:id="rId7"/><sheet name="Other" sheetId="2" r:id="rId8"/>'
        "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels":
        '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="rId8" Target="worksheets/sheet2.xml"/>'
        '<Relationship Id="rId7" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet {MAIN}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        "xl/sharedStrings.xml": f"<sst {MAIN}>"
        + "".join(f"<si><t>{escape(s)}</t></si>" for s in shared) + "</sst>",
        "xl/worksheets/sheet1.xml": f"<worksheet {MAIN}><sheetData>{''.join(lines)}</sheetData></worksheet>",
        "xl/worksheets/sheet2.xml": f"<worksheet {MAIN}><sheetData/></worksheet>",
    }
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in parts.items():
            archive.writestr(name, text)
    return target.getvalue()
