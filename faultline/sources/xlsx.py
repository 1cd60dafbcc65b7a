"""Reads the cells of one sheet out of a workbook's bytes. Runs inside tasks, one file at a time."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree as ET
from xml.parsers import expat

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

# Number formats 14-22 and 45-47 show dates or times; 46 shows elapsed hours.
BUILT_IN_DATES = frozenset((*range(14, 23), 45, 47))
BUILT_IN_ELAPSED = frozenset((46,))
PIECE_BYTES = 1 << 16


def _column_index(ref: str) -> int:
    n = 0
    for letter in ref.rstrip("0123456789"):
        n = n * 26 + ord(letter.upper()) - 64
    return n - 1


def _text_of(node: ET.Element) -> str:
    """Text of a string item, without phonetic hints."""
    parts = [t.text or "" for t in node.findall(f"{MAIN}t")]
    parts += [t.text or "" for run in node.findall(f"{MAIN}r") for t in run.findall(f"{MAIN}t")]
    return "".join(parts)


def _style_kinds(book: zipfile.ZipFile) -> list[str]:
    """For every cell style: 'date', 'elapsed' or 'number'."""
    if "xl/styles.xml" not in book.namelist():
        return []
    root = ET.fromstring(book.read("xl/styles.xml"))
    codes = {int(f.get("numFmtId")): f.get("formatCode") or "" for f in root.iter(f"{MAIN}numFmt")}

    def kind(fmt: int) -> str:
        code = codes.get(fmt)
        if code is None:
            if fmt in BUILT_IN_ELAPSED:
                return "elapsed"
            return "date" if fmt in BUILT_IN_DATES else "number"
        shown = re.sub(r'"[^"]*"|\\.', "", code.split(";")[0]).lower()
        if re.search(r"\[(h+|m+|s+)\]", shown):
            return "elapsed"
        return "date" if re.search("[dmyhs]", re.sub(r"\[[^\]]*\]", "", shown)) else "number"

    styles = root.find(f"{MAIN}cellXfs")
    return [kind(int(x.get("numFmtId", 0))) for x in styles] if styles is not None else []


def _date_text(serial: float, first_1904: bool) -> str:
    """Date, clock time or both of a serial day number. Serial 60 is a day that never was."""
    day, fraction = divmod(serial, 1)
    clock = timedelta(milliseconds=round(fraction * 86_400_000))
    if 0 <= serial < 1 and clock < timedelta(days=1):
        return str((datetime.min + clock).time())
    if first_1904:
        return str(datetime(1904, 1, 1) + timedelta(days=day) + clock)
    return str(datetime(1899, 12, 30) + timedelta(days=day + (0 < serial < 60)) + clock)


def _number_text(value: str, kind: str, first_1904: bool) -> str:
    number = float(value)
    if kind == "date":
        return _date_text(number, first_1904)
    if kind == "elapsed":
        return str(timedelta(days=number))
    return str(int(number)) if number.is_integer() else repr(number)


class _Rows:
    """Collects finished rows while a sheet streams through the XML parser."""

    def __init__(self, cell_text: Callable[[dict, str | None], str | None]):
        self.finished: list[tuple[int, list[str | None]]] = []
        self._cell_text = cell_text
        self._row = -1
        self._cells: list[str | None] = []
        self._cell: dict = {}
        self._value: str | None = None
        self._reading = False
        self._phonetic = False

    def start(self, tag: str, attributes: dict) -> None:
        name = tag.rpartition(" ")[2]
        if name == "c":
            self._cell, self._value = attributes, None
        elif name in ("v", "t"):
            self._reading = not self._phonetic
        elif name == "row":
            self._row, self._cells = int(attributes.get("r", self._row + 2)) - 1, []
        elif name == "rPh":
            self._phonetic = True

    def text(self, data: str) -> None:
        if self._reading:
            self._value = data if self._value is None else self._value + data

    def end(self, tag: str) -> None:
        name = tag.rpartition(" ")[2]
        if name in ("v", "t"):
            self._reading = False
        elif name == "c":
            ref = self._cell.get("r")
            at = _column_index(ref) if ref else len(self._cells)
            self._cells += [None] * (at - len(self._cells))
            self._cells.append(self._cell_text(self._cell, self._value))
        elif name == "row":
            self.finished.append((self._row, self._cells))
        elif name == "rPh":
            self._phonetic = False


def read_sheet(content: bytes, sheet: str) -> Iterator[tuple[int, list[str | None]]]:
    """(row index from 0, cell texts) of every stored row; blank cells are None.

    The sheet is unpacked and parsed piece by piece, so a long one needs no more memory.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        workbook = ET.fromstring(book.read("xl/workbook.xml"))
        targets = {
            r.get("Id"): r.get("Target").lstrip("/").removeprefix("xl/")
            for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        }
        sheets = {s.get("name"): s.get(REL_ID) for s in workbook.iter(f"{MAIN}sheet")}
        if sheet not in sheets:
            raise ValueError(f"no sheet named {sheet!r}")
        props = workbook.find(f"{MAIN}workbookPr")
        first_1904 = props is not None and props.get("date1904") in ("1", "true")
        kinds = _style_kinds(book)
        strings: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            root = ET.fromstring(book.read("xl/sharedStrings.xml"))
            strings = [_text_of(item) for item in root.findall(f"{MAIN}si")]

        def cell_text(cell: dict, value: str | None) -> str | None:
            kind = cell.get("t", "n")
            if value is None or kind == "e":
                return None
            if kind == "s":
                return strings[int(value)]
            if kind == "b":
                return str(value == "1")
            if kind == "n":
                style = int(cell.get("s", 0))
                return _number_text(value, kinds[style] if style < len(kinds) else "", first_1904)
            return value

        rows = _Rows(cell_text)
        parser = expat.ParserCreate(namespace_separator=" ")
        parser.buffer_text = True
        parser.StartElementHandler = rows.start
        parser.CharacterDataHandler = rows.text
        parser.EndElementHandler = rows.end
        with book.open(f"xl/{targets[sheets[sheet]]}") as stream:
            while piece := stream.read(PIECE_BYTES):
                parser.Parse(piece)
                yield from rows.finished
                rows.finished.clear()
            parser.Parse(b"", True)
        yield from rows.finished
