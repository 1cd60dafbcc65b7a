import datetime as dt
import io
import zipfile

import pytest

from faultline.operators import rawlayout
from xlsx_fixture import workbook_bytes
from faultline.schemas import BRONZE, RAW_COLUMNS
from faultline.sources import workbooks, xlsx
from faultline.streaming.ingest import ingest_workbooks

HEADER = [c if c != "event_no" else " Event No " for c in RAW_COLUMNS]


def sheet(preamble, *data):
    return [["title"], *[["junk"]] * (preamble - 1), HEADER + ["extra"], *data]


def row(date, feeder="ROM", no=1, **cells):
    values = dict.fromkeys(RAW_COLUMNS)
    values |= {"date_raw": date, "name_of_affected_feeder": feeder, "event_no": no, **cells}
    return list(values.values())


def drop(folder, name, rows, sheet_name="RAW MONTHLY"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(workbook_bytes({"SUMMARY OF x": [["Event No"]], sheet_name: rows}))


def bronze_of(spark, folder):
    return rawlayout.to_bronze(workbooks.read_workbooks(spark, str(folder)))


def test_workbooks_become_bronze(spark, tmp_path):
    day = dt.date(2021, 1, 5)
    drop(
        tmp_path,
        "region JANUARY 2021.xlsx",
        sheet(2, row(day, start_time=dt.time(14, 30), duration_hours=1.5, remarks="N/A"),
              ["33kV FEEDERS OUTAGES"], [None], row(dt.date(1900, 1, 7), no=12)),
    )
    drop(tmp_path, "sub/september.XLSX", sheet(3, row("05/01/2021", duration_hours=2.0)))
    (tmp_path / "notes.txt").write_text("not a workbook")
    rows = bronze_of(spark, tmp_path)
    assert rows.schema.names == BRONZE.names
    assert {f.dataType.typeName() for f in rows.schema} == {"string"}
    got = sorted(rows.collect(), key=lambda r: (r.source_month, r.date_raw or ""))
    assert [(r.source_month, r.date_raw, r.event_no) for r in got] == [
        ("JANUARY", None, None),
        ("JANUARY", "1900-01-07 00:00:00", "12"),
        ("JANUARY", "2021-01-05 00:00:00", "1"),
        ("JANUARY", "33kV FEEDERS OUTAGES", None),
        ("SEPTEMBER", "05/01/2021", "1"),
    ]
    first = got[2]
    assert (first.start_time, first.duration_hours, first.remarks) == ("14:30:00", "1.5", None)
    assert got[4].duration_hours == "2" and got[4].source_file == "september.XLSX"
    assert len({r.ingested_at for r in got}) == 1 and got[0].ingested_at.endswith("+00:00")


def test_no_workbook_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x")
    with pytest.raises(FileNotFoundError):
        workbooks.list_workbooks(spark, str(tmp_path))


@pytest.mark.parametrize("header_at, found", [(2, True), (3, True), (9, True), (10, False)])
def test_header_is_sought_in_the_first_ten_rows(spark, tmp_path, header_at, found):
    drop(tmp_path, "may.xlsx", sheet(header_at, row("2021-05-01")))
    if found:
        assert bronze_of(spark, tmp_path).count() == 1
    else:
        with pytest.raises(Exception, match="no header row"):
            bronze_of(spark, tmp_path).count()


@pytest.mark.parametrize(
    "rows, name, message",
    [
        ([["no header here"]], "RAW MONTHLY", "no header row"),
        ([["Event No", "b"], ["1", "2"]], "RAW MONTHLY", "2 columns"),
        (sheet(2, row("2021-05-01")), "RAW", "no sheet named"),
    ],
)
def test_unusable_workbook_fails(spark, tmp_path, rows, name, message):
    drop(tmp_path, "may.xlsx", rows, name)
    with pytest.raises(Exception, match=message):
        bronze_of(spark, tmp_path).count()


def test_rows_keep_their_sheet_position(spark, tmp_path):
    many = [row("2021-05-01", no=i) for i in range(10_000)]
    drop(tmp_path, "may.xlsx", sheet(2, *many, [None], [None]))
    grid = workbooks.read_workbooks(spark, str(tmp_path))
    assert grid.count() == 10_003
    got = grid.filter("row_idx > header_idx").selectExpr("row_idx - 3 - int(cells[3]) AS d")
    assert [r.d for r in got.distinct().collect()] == [0]


@pytest.mark.parametrize(
    "serial, first_1904, shown",
    [
        (44201.0, False, "2021-01-05 00:00:00"),
        (44201.5, False, "2021-01-05 12:00:00"),
        (7.0, False, "1900-01-07 00:00:00"),
        (61.0, False, "1900-03-01 00:00:00"),
        (0.0, False, "00:00:00"),
        (0.604166666666667, False, "14:30:00"),
        (1.0, False, "1900-01-01 00:00:00"),
        (1.0, True, "1904-01-02 00:00:00"),
    ],
)
def test_serial_dates(serial, first_1904, shown):
    assert xlsx._date_text(serial, first_1904) == shown


@pytest.mark.parametrize(
    "value, kind, shown",
    [("5", "number", "5"), ("5.0", "number", "5"), ("5.25", "number", "5.25"),
     ("1.25", "elapsed", "1 day, 6:00:00")],
)
def test_number_texts(value, kind, shown):
    assert xlsx._number_text(value, kind, False) == shown


def test_new_workbooks_are_streamed_into_bronze(spark, tmp_path):
    raw = tmp_path / "raw"
    folders = str(raw), str(tmp_path / "bronze"), str(tmp_path / "offsets")
    drop(raw, "may.xlsx", sheet(2, row("2021-05-01"), row("2021-05-02")))
    assert ingest_workbooks(spark, *folders).count() == 2
    drop(raw, "june.xlsx", sheet(3, row("2021-06-01")))
    landed = ingest_workbooks(spark, *folders)
    assert {(r.source_month, r.date_raw) for r in landed.collect()} == {
        ("MAY", "2021-05-01"), ("MAY", "2021-05-02"), ("JUNE", "2021-06-01"),
    }
    columns = [c for c in BRONZE.names if c != "ingested_at"]
    batch = bronze_of(spark, raw).select(*columns)
    assert batch.exceptAll(landed.select(*columns)).isEmpty()
    assert ingest_workbooks(spark, *folders).count() == 3


def test_inline_texts_formulas_errors_and_unnamed_rows():
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    body = (
        '<row><c t="inlineStr"><is><r><t>a</t></r><r><t>&amp;b</t></r><rPh><t>x</t></rPh></is></c>'
        '<c t="b"><v>1</v></c><c t="e"><v>#N/A</v></c><c t="str"><f>A1&amp;"z"</f><v>az</v></c>'
        '<c/><c><v>1e3</v></c></row><row r="4"><c r="AB4"><v>2.50</v></c></row>'
    )
    sheet_xml = f"<x:worksheet {ns.replace('xmlns', 'xmlns:x')}><sheetData {ns}>{body}</sheetData></x:worksheet>"
    source = zipfile.ZipFile(io.BytesIO(workbook_bytes({"S": [["y"]]})))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        for name in source.namelist():
            data = sheet_xml if name.endswith("s1.xml") else source.read(name)
            book.writestr(name, data)
    rows = list(xlsx.read_sheet(out.getvalue(), "S"))
    assert rows[0] == (0, ["a&b", "True", None, "az", None, "1000"])
    assert rows[1] == (3, [None] * 27 + ["2.5"])
