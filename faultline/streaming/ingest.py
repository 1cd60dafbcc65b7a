"""Ingestion of newly dropped files: each run takes what arrived since the last one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from faultline.operators.rawlayout import to_bronze
from faultline.schemas import BINARY_FILE, BRONZE, MONTH_COLUMN
from faultline.sources.tables import read_table
from faultline.sources.workbooks import WORKBOOK_GLOB, scan_workbooks


def _land(
    rows: DataFrame, target: str, checkpoint: str, partition_by: str | None
) -> None:
    """Append to a Parquet folder. The sink's log lists the files of finished batches, so a
    batch that is repeated after a failure does not count twice."""
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    query = writer.start(target)
    query.awaitTermination()


def ingest_parquet(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    partition_by: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """Run every new Parquet file through a row-wise transform; returns the whole target."""
    arrived = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    )
    landed = transform(arrived)
    _land(landed, target, checkpoint, partition_by)
    return read_table(spark, target, landed.schema)


def ingest_workbooks(
    spark: SparkSession, source: str, target: str, checkpoint: str, files_per_batch: int = 1000
) -> DataFrame:
    """Land new workbooks in bronze; returns the whole bronze table."""
    arrived = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", WORKBOOK_GLOB)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
    )
    _land(to_bronze(scan_workbooks(arrived)), target, checkpoint, MONTH_COLUMN)
    return read_table(spark, target, BRONZE)
