"""From a grid of raw cells to named text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions import rules
from faultline.functions.text import base_name, month_from_name, null_tokens, strip
from faultline.schemas import RAW_COLUMNS

# Rows of one file that may meet in one join task.
CHUNK_ROWS = 100_000


def has_cell(cells: Column | str, marker: str = rules.HEADER_CELL) -> Column:
    cells = F.col(cells) if isinstance(cells, str) else cells
    return F.exists(cells, lambda c: strip(c) == marker)


def header_rows(
    grid: DataFrame,
    is_header: Column,
    file: str = "source_file",
    row: str = "row_idx",
    search_rows: int = rules.HEADER_SEARCH_ROWS,
) -> DataFrame:
    """One row per file: its header row (null when none is near the top) and its last row."""
    near_top = F.col(row) < search_rows
    return grid.groupBy(file).agg(
        F.min(F.when(near_top & is_header, F.col(row))).alias("header_idx"),
        F.max(row).alias("last_idx"),
    )


def rows_after_header(
    grid: DataFrame,
    is_header: Column,
    file: str = "source_file",
    row: str = "row_idx",
    search_rows: int = rules.HEADER_SEARCH_ROWS,
    on_missing: str = "fail",
) -> DataFrame:
    """Rows below the header row of their file.

    A file without a header fails the job, or gives no rows with on_missing="report"; such
    files are then listed by `files_without_header`. The join runs on (file, chunk of rows),
    so one very long file is spread over many tasks. A chunk never exceeds CHUNK_ROWS because
    row numbers are unique within a file.
    """
    headers = header_rows(grid, is_header, file, row, search_rows)
    if on_missing == "fail":
        missing = F.raise_error(F.concat(F.lit("no header row in "), F.col(file).cast("string")))
        headers = headers.withColumn(
            "header_idx",
            F.when(F.col("header_idx").isNull(), missing.cast("bigint"))
            .otherwise(F.col("header_idx")),
        )
    chunk = F.floor(F.col(row) / CHUNK_ROWS)
    chunks = headers.select(
        file,
        "header_idx",
        F.explode(
            F.sequence(
                F.floor(F.col("header_idx") / CHUNK_ROWS), F.floor(F.col("last_idx") / CHUNK_ROWS)
            )
        ).alias("__chunk"),
    )
    return (
        grid.withColumn("__chunk", chunk)
        .join(chunks, [file, "__chunk"])
        .filter(F.col(row) > F.col("header_idx"))
        .drop("__chunk")
    )


def files_without_header(
    grid: DataFrame,
    is_header: Column,
    file: str = "source_file",
    row: str = "row_idx",
    search_rows: int = rules.HEADER_SEARCH_ROWS,
) -> DataFrame:
    headers = header_rows(grid, is_header, file, row, search_rows)
    return headers.filter(F.col("header_idx").isNull()).select(file)


def named_cells(cells: Column | str, names: tuple[str, ...] = RAW_COLUMNS) -> list[Column]:
    """Cells by position as text columns; cells past the last name are cut, blanks are null."""
    cells = F.col(cells) if isinstance(cells, str) else cells
    return [null_tokens(F.get(cells, F.lit(i))).alias(n) for i, n in enumerate(names)]


def provenance(path: Column | str, ingested_at: Column | None = None) -> list[Column]:
    """File name, load time (one value per run) and the month named in the file name."""
    name = base_name(path)
    loaded = F.date_format(
        F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
        "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'",
    )
    return [
        name.alias("source_file"),
        (loaded if ingested_at is None else ingested_at).alias("ingested_at"),
        month_from_name(name).alias("source_month"),
    ]


def to_bronze(grid: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Bronze rows of a workbook grid: everything below the header, unfiltered, all text."""
    data = grid.filter(F.col("row_idx") > F.col("header_idx"))
    return data.select(*named_cells("cells"), *provenance("source_file", ingested_at))


def load_summary(bronze: DataFrame, month: str = "source_month") -> DataFrame:
    """Rows and distinct months of a load."""
    return bronze.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct(month).alias("n_months")
    )
