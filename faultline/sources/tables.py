"""Table scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.schemas import LOCATIONS


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet below a folder; partition values keep the type the schema gives them."""
    return spark.read.schema(schema).parquet(path)


def read_table_or_fail(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    table = read_table(spark, path, schema)
    if table.isEmpty():
        raise FileNotFoundError(f"no rows below {path}")
    return table


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """Locations from CSV. Quotes are doubled inside quoted fields, which may hold line breaks;
    blanks are null."""
    return (
        spark.read.schema(LOCATIONS)
        .option("header", "true")
        .option("escape", '"')
        .option("multiLine", "true")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | list[str] | None = None,
    replace_only_written: bool = False,
    single_file: bool = False,
) -> None:
    """Overwrite a Parquet table.

    `single_file` is for results that are small by construction, such as one row per asset,
    and comes after their shuffle.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if replace_only_written:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def gathered(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of one partition value in few tasks, for a table that mixes all values.

    Without this every task would write a file per value. Spark cuts what it gathers into
    pieces of its advisory size, so a value with a third of all rows takes many tasks.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_checked(
    spark: SparkSession, df: DataFrame, path: str, partition_by: str | None = None
) -> int:
    """Write, then open the result again: an unreadable or short table fails here. Returns the
    number of rows.

    The rows are counted while they are written, so the input runs once.
    """
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("n")), path, partition_by)
    back = spark.read.parquet(path)
    expected = {f.name: f.dataType for f in df.schema if f.name != partition_by}
    found = {f.name: f.dataType for f in back.schema if f.name != partition_by}
    if expected != found:
        raise RuntimeError(f"{path}: wrote {expected}, found {found}")
    written, stored = seen.get["n"], back.count()
    if written != stored:
        raise RuntimeError(f"{path}: wrote {written} rows, found {stored}")
    return stored


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns, matched by name."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole
