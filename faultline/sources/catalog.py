"""External tables and views over a stored lake."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from faultline import schemas
from faultline.operators.quality import Constraint, judged, observed
from faultline.sources.tables import write_checked

# Table name -> schema, folder below the lake, partition column.
LAKE_TABLES: dict[str, tuple[T.StructType, str, str | None]] = {
    "interruptions_clean": (
        schemas.SILVER, "silver/interruptions/quarantined=false", schemas.MONTH_COLUMN),
    "interruptions_quarantine": (
        schemas.SILVER, "silver/interruptions/quarantined=true", schemas.MONTH_COLUMN),
    "mttr_mtbf_by_feeder": (schemas.RELIABILITY, "gold/mttr_mtbf_by_feeder", None),
    "classifier_features": (
        schemas.FEATURES, "gold/classifier_features", schemas.MONTH_COLUMN),
    "classifier_predictions": (schemas.PREDICTIONS, "gold/classifier_predictions", None),
}


def _quoted(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)


def create_parquet_table(
    spark: SparkSession,
    database: str,
    name: str,
    schema: T.StructType,
    location: str,
    partition_by: str | None = None,
) -> None:
    """External table over Parquet that is already there; its partitions become known.

    A table of this name is replaced: it then reads the folder and the columns given last. Its
    files stay, since the table is external.
    """
    table = _quoted(database, name)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    partitions = f"PARTITIONED BY ({_quoted(partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE {table} ({_columns_ddl(schema)}) USING parquet "
        f"{partitions} LOCATION :location",
        args={"location": location},
    )
    if partition_by:
        refresh_partitions(spark, database, name)


def refresh_partitions(spark: SparkSession, database: str, name: str) -> None:
    """Make partitions that were written after the table was created visible."""
    spark.catalog.recoverPartitions(_quoted(database, name))


def publish_partition(
    spark: SparkSession,
    df: DataFrame,
    database: str,
    name: str,
    partition: tuple[str, str],
    folder: str,
    constraints: Sequence[Constraint] = (),
) -> dict[str, int]:
    """Replace one partition of an external table in a single step of the catalog.

    The rows are written to a new folder, counted against the constraints while they are, and
    read back; only then does the partition point there. A reader sees the old rows or the new
    ones, never a mixture, and a table that does not hold changes nothing. Returns the
    violations that only warn. The folder that was in use stays for readers that have begun;
    :func:`partition_folder` tells what it was.
    """
    column, value = partition
    staged = f"{folder}/{uuid.uuid4().hex}"
    counted, seen = observed(df.drop(column), list(constraints))
    write_checked(spark, counted, staged)
    warnings = judged(seen, list(constraints))
    table, spec = _quoted(database, name), f"PARTITION ({_quoted(column)} = {_text(value)})"
    if spark.sql(f"SHOW PARTITIONS {table} {spec}").isEmpty():
        spark.sql(f"ALTER TABLE {table} ADD {spec} LOCATION {_text(staged)}")
    else:
        spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION {_text(staged)}")
    spark.catalog.refreshTable(table)
    return warnings


def partition_folder(spark: SparkSession, database: str, name: str, partition: tuple[str, str]) -> str:
    """Where the rows of a partition are now."""
    spec = f"PARTITION ({_quoted(partition[0])} = {_text(partition[1])})"
    rows = spark.sql(f"DESCRIBE EXTENDED {_quoted(database, name)} {spec}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def create_locations_table(spark: SparkSession, database: str, location: str) -> None:
    """External CSV table, replaced if there is one; every column stays text and is cast by
    the queries."""
    table = _quoted(database, "feeder_locations")
    columns = ", ".join(f"{_quoted(f.name)} string" for f in schemas.LOCATIONS)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({columns}) "
        "USING csv OPTIONS (header 'true', escape '\"', multiLine 'true') LOCATION :location",
        args={"location": location},
    )


def register_lake(spark: SparkSession, database: str, lake: str, locations_csv: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    for name, (schema, folder, partition_by) in LAKE_TABLES.items():
        create_parquet_table(spark, database, name, schema, f"{lake}/{folder}", partition_by)
    create_locations_table(spark, database, locations_csv)


def view_texts(database: str) -> dict[str, str]:
    """The four reports as query text over the lake's tables. The rows are as many as there
    are assets, types or classes, so a window over all of them is small."""

    def table(name: str) -> str:
        return _quoted(database, name)

    numbers = ", ".join(
        f"try_cast(l.{c} AS double) AS {c}" for c in ("latitude", "longitude", "service_radius_km")
    )
    plain = "regexp_replace(cast(try_cast(l.{c} AS double) AS string), '\\\\.0$', '')"
    point = (
        f"concat('POINT (', {plain.format(c='longitude')}, ' ', {plain.format(c='latitude')}, ')')"
    )
    return {
        "mttr_mtbf_leaderboard": f"""SELECT *,
            rank() OVER (ORDER BY mtbf_hours ASC NULLS LAST) AS reliability_rank
            FROM {table("mttr_mtbf_by_feeder")}""",
        "outage_type_summary": f"""SELECT outage_type_canonical, count(*) AS total_events,
            round(100.0D * count(*) / sum(count(*)) OVER (), 1) AS pct_of_all_events,
            round(avg(duration_hours_num), 2) AS avg_duration_hours,
            round(sum(customer_hours_interruption_num), 1) AS total_customer_hours_interruption
            FROM {table("classifier_features")} WHERE NOT is_transformer_event
            GROUP BY outage_type_canonical""",
        "feeder_reliability_map": f"""SELECT m.*, l.confidence AS location_confidence, l.setting,
            {numbers}, {point} AS location_wkt
            FROM {table("mttr_mtbf_by_feeder")} m LEFT JOIN {table("feeder_locations")} l
            ON m.feeder_canonical = l.feeder_canonical""",
        "classifier_accuracy_by_type": f"""SELECT outage_type_canonical AS actual_outage_type,
            count(*) AS test_set_events, count_if(correct) AS correct_predictions,
            round(100.0D * count_if(correct) / count(*), 1) AS accuracy_pct
            FROM {table("classifier_predictions")} GROUP BY outage_type_canonical""",
    }


def create_views(spark: SparkSession, database: str) -> list[str]:
    """The reports as stored views of the database: any session of its catalog can query them."""
    texts = view_texts(database)
    for name, text in texts.items():
        spark.sql(f"CREATE OR REPLACE VIEW {_quoted(database, name)} AS {text}")
    return list(texts)
