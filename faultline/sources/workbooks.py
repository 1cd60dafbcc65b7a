"""Workbooks as a table of raw cells, parsed on the executors."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from faultline.functions import rules
from faultline.functions.text import base_name
from faultline.schemas import RAW_COLUMNS
from faultline.sources.xlsx import read_sheet

WORKBOOK_GLOB = "*.[xX][lL][sS][xX]"
GRID_ROWS = "source_file string, header_idx int, row_idx int, cells array<string>"
_ARROW_GRID = pa.schema(
    [
        ("source_file", pa.string()),
        ("header_idx", pa.int32()),
        ("row_idx", pa.int32()),
        ("cells", pa.list_(pa.string())),
    ]
)
_ROWS_PER_BATCH = 4096


def list_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content) of every workbook below a folder; an error when there is none."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", WORKBOOK_GLOB)
        .load(folder)
    )
    if files.select("path").isEmpty():
        raise FileNotFoundError(f"no .xlsx file below {folder}")
    return files.select("path", "content")


def header_index(rows: list[list[str | None]], marker: str = rules.HEADER_CELL) -> int | None:
    """Index of the first row with a cell that reads `marker`."""
    for i, cells in enumerate(rows):
        if any(c is not None and c.strip() == marker for c in cells):
            return i
    return None


def _dense_rows(content: bytes, sheet: str) -> Iterator[list[str | None]]:
    """Cells of each sheet row: rows that are not stored are empty ones, but none at the end."""
    expected = 0
    for row_idx, cells in read_sheet(content, sheet):
        if all(c is None for c in cells):
            continue
        for _ in range(row_idx - expected):
            yield []
        expected = row_idx + 1
        yield cells


def _workbook_batches(name: str, content: bytes, sheet: str) -> Iterator[pa.RecordBatch]:
    rows = _dense_rows(content, sheet)
    top = [cells for _, cells in zip(range(rules.HEADER_SEARCH_ROWS), rows)]
    header = header_index(top)
    if header is None:
        raise ValueError(f"{name}: no header row with a cell {rules.HEADER_CELL!r}")
    width = 0
    pending: list[list[str | None]] = top
    first = 0

    def batch() -> pa.RecordBatch:
        n = len(pending)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name] * n, pa.string()),
                pa.array([header] * n, pa.int32()),
                pa.array(range(first, first + n), pa.int32()),
                pa.array(pending, pa.list_(pa.string())),
            ],
            schema=_ARROW_GRID,
        )

    for cells in top:
        width = max(width, len(cells))
    for cells in rows:
        width = max(width, len(cells))
        if len(pending) == _ROWS_PER_BATCH:
            yield batch()
            first, pending = first + len(pending), []
        pending.append(cells)
    if width < len(RAW_COLUMNS):
        raise ValueError(f"{name}: {width} columns, expected at least {len(RAW_COLUMNS)}")
    yield batch()


def scan_workbooks(files: DataFrame, sheet: str = rules.SHEET_NAME) -> DataFrame:
    """Raw cell rows of the named sheet of each file, with the position of its header row.

    Every file is read once and streamed in small batches. Nothing is shuffled: the header is
    found while the rows pass by, so no second scan and no join is needed to skip to it.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files_batch in batches:
            names, contents = files_batch.column("source_file"), files_batch.column("content")
            for i in range(files_batch.num_rows):
                yield from _workbook_batches(names[i].as_py(), contents[i].as_py(), sheet)

    named = files.select(base_name("path").alias("source_file"), "content")
    return named.mapInArrow(parse, GRID_ROWS)


def read_workbooks(spark: SparkSession, folder: str, sheet: str = rules.SHEET_NAME) -> DataFrame:
    return scan_workbooks(list_workbooks(spark, folder), sheet)
