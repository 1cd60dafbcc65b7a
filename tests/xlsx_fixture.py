"""Writes small workbooks, as input for the workbook scan."""

from __future__ import annotations

import io
import zipfile
from datetime import date, datetime, time
from xml.sax.saxutils import escape, quoteattr

_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG = "http://schemas.openxmlformats.org/package/2006"
# Style 0 is plain, 1 shows a date, 2 shows a clock time.
_STYLES = (
    f'<styleSheet {_NS}><numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/>'
    '</numFmts><cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="164"/><xf numFmtId="21"/>'
    "</cellXfs></styleSheet>"
)


def _letters(index: int) -> str:
    out = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        out = chr(65 + rest) + out
    return out


def _cell(ref: str, value, strings: dict[str, int]) -> str:
    if isinstance(value, str):
        at = strings.setdefault(value, len(strings))
        return f'<c r="{ref}" t="s"><v>{at}</v></c>'
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, time):
        seconds = value.hour * 3600 + value.minute * 60 + value.second
        return f'<c r="{ref}" s="2"><v>{seconds / 86400!r}</v></c>'
    if isinstance(value, (date, datetime)):
        days = (date(value.year, value.month, value.day) - date(1899, 12, 30)).days
        if days < 61:
            days -= 1
        return f'<c r="{ref}" s="1"><v>{days}</v></c>'
    return f'<c r="{ref}"><v>{float(value)!r}</v></c>'


def _sheet(rows: list[list], strings: dict[str, int]) -> str:
    body = []
    for i, row in enumerate(rows, start=1):
        cells = [_cell(f"{_letters(j)}{i}", v, strings) for j, v in enumerate(row) if v is not None]
        if cells:
            body.append(f'<row r="{i}">{"".join(cells)}</row>')
    return f"<worksheet {_NS}><sheetData>{''.join(body)}</sheetData></worksheet>"


def workbook_bytes(sheets: dict[str, list[list]]) -> bytes:
    """A workbook with the given sheets; None leaves a cell out."""
    strings: dict[str, int] = {}
    parts = {f"xl/worksheets/s{i}.xml": _sheet(rows, strings)
             for i, rows in enumerate(sheets.values(), start=1)}
    entries = "".join(
        f'<sheet name={quoteattr(name)} sheetId="{i}" r:id="rId{i}"/>'
        for i, name in enumerate(sheets, start=1)
    )
    links = "".join(
        f'<Relationship Id="rId{i}" Type="{_REL}/worksheet" Target="worksheets/s{i}.xml"/>'
        for i in range(1, len(sheets) + 1)
    )
    items = "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in strings)
    parts |= {
        "xl/workbook.xml": f'<workbook {_NS} xmlns:r="{_REL}"><sheets>{entries}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PKG}/relationships">{links}</Relationships>',
        "xl/sharedStrings.xml": f"<sst {_NS}>{items}</sst>",
        "xl/styles.xml": _STYLES,
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return out.getvalue()
